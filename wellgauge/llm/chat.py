"""Chat formatting with typed content parts.

A message's content is an array of parts of kind ``text``, ``image``, ``audio`` or
``document``. A visitor goes through the parts in order: text is escaped, anything
else becomes a placeholder, with a reference to the attachment and the number of
tokens that a model will put in its place. A turn reads

    <|im_start|>role
    content<|im_end|>

and a line feed. Control strings within texts and roles are escaped by a backslash after
``<``, and a run of backslashes there grows by one, so that what is text can be told from
what is markup and everything can be read back.

Turns are formatted one by one, wherever they are; only their lengths are summed over a
conversation. Turns are ordered by number, then role, then content; a NULL turn number
comes first. NULL texts and roles are empty, NULL or empty content has no part, and parts
of unknown kind are kept as documents. Repeated rows are turns of their own.
"""

from __future__ import annotations

import re
from collections.abc import Iterator, Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# The marks of the template.
START, END, LINE = "<|im_start|>", "<|im_end|>", "<|line|>"
PARTS = "array<struct<kind:string,text:string,uri:string,units:int>>"
KINDS = ("image", "audio", "document")
PLACEHOLDERS = {kind: f"<|{kind}|>" for kind in KINDS}
# Tokens that a unit of an attachment expands to: an image tile, a second of audio, a
# page of a document.
TOKENS_PER_UNIT = {"image": 256, "audio": 25, "document": 512}

_MARKED = re.compile(r"<(\\*)\|")
_TURN = re.compile(
    f"{re.escape(START)}([^\n]*)\n(.*?){re.escape(END)}\n", re.DOTALL
)
_ESCAPED = re.compile(r"<(\\*)\\\|")
_KIND_OF = {mark: kind for kind, mark in PLACEHOLDERS.items()}
_PLACEHOLDER = re.compile("|".join(map(re.escape, _KIND_OF)))


def escaped(text: Column) -> Column:
    r"""``<|`` becomes ``<\|``, ``<\|`` becomes ``<\\|`` and so on."""
    return F.regexp_replace(text, r"<(\\*)\|", r"<$1\\|")


def unescaped(text: Column) -> Column:
    return F.regexp_replace(text, r"<(\\*)\\\|", r"<$1|")


def escape(text: str) -> str:
    """The same for Python strings."""
    return _MARKED.sub(lambda m: f"<{m[1]}\\|", text)


def unescape(text: str) -> str:
    return _ESCAPED.sub(lambda m: f"<{m[1]}|", text)


def text_part(text: Column) -> Column:
    """Content that is one text."""
    null = F.lit(None)
    return F.array(
        F.struct(
            F.lit("text").alias("kind"),
            F.coalesce(text, F.lit("")).alias("text"),
            null.cast("string").alias("uri"),
            null.cast("int").alias("units"),
        )
    )


def _kind(part: Column) -> Column:
    known = part["kind"].isin("text", *KINDS)
    return F.when(known, part["kind"]).otherwise("document")


def _body(parts: Column) -> Column:
    """What the parts read in the formatted text. Texts side by side are escaped as one:
    a control string may begin in one and end in the next. So all are joined before they
    are escaped, which also takes time by the length of a message, however many parts it
    has; until then attachments stand as a NUL and a letter, and a NUL of a text as a NUL
    and another."""
    nul = "\0"
    signs = {kind: f"{nul}{kind[0]}" for kind in KINDS}

    def sign(part: Column) -> Column:
        text = F.coalesce(part["text"], F.lit(""))
        shown = F.replace(text, F.lit(nul), F.lit(f"{nul}t"))
        for kind in KINDS:
            shown = F.when(_kind(part) == kind, F.lit(signs[kind])).otherwise(shown)
        return shown

    body = escaped(F.array_join(F.transform(parts, sign), ""))
    for kind in KINDS:
        body = F.replace(body, F.lit(signs[kind]), F.lit(PLACEHOLDERS[kind]))
    return F.replace(body, F.lit(f"{nul}t"), F.lit(nul))


def _tokens(part: Column, per_unit: Mapping[str, int]) -> Column:
    """Tokens an attachment expands to; at least one unit."""
    each = F.lit(0).cast("long")
    units = F.greatest(F.coalesce(part["units"], F.lit(1)), F.lit(1)).cast("long")
    for kind, n in per_unit.items():
        each = F.when(_kind(part) == kind, units * n).otherwise(each)
    return each


def format_turns(
    messages: DataFrame,
    content: str = "content",
    conversation: str = "conv_id",
    turn: str = "turn",
    role: str = "role",
    tokens_per_unit: Mapping[str, int] = TOKENS_PER_UNIT,
) -> DataFrame:
    """One row per message: conversation, ``turn``, ``role``, ``formatted`` (the
    turn's text), ``loss_start`` and ``loss_end`` (code points of the content within it;
    the loss mask of assistant turns, else NULL), ``attachments`` (kind, uri and place in
    order) and ``expanded_tokens``, by the model's ``tokens_per_unit``. No shuffle."""
    parts = F.filter(
        F.coalesce(F.col(content), F.array().cast(PARTS)), lambda p: p.isNotNull()
    )
    who = F.coalesce(F.col(role), F.lit(""))
    shown = F.replace(escaped(who), F.lit("\n"), F.lit(LINE))  # a role is one line
    head = F.concat(F.lit(START), shown, F.lit("\n"))
    body = _body(parts)
    others = F.filter(parts, lambda p: _kind(p) != "text")
    trained = who == "assistant"
    return messages.select(
        F.col(conversation),
        F.col(turn).alias("turn"),
        who.alias("role"),
        F.concat(head, body, F.lit(END + "\n")).alias("formatted"),
        F.when(trained, F.length(head)).alias("loss_start"),
        F.when(trained, F.length(head) + F.length(body)).alias("loss_end"),
        F.transform(
            others,
            lambda p, i: F.struct(_kind(p).alias("kind"), p["uri"].alias("uri"), i.alias("place")),
        ).alias("attachments"),
        F.aggregate(
            parts, F.lit(0).cast("long"), lambda n, p: n + _tokens(p, tokens_per_unit)
        ).alias("expanded_tokens"),
    )


def with_offsets(turns: DataFrame, conversation: str = "conv_id") -> DataFrame:
    """Add ``offset``: where a turn starts in its conversation's formatted text."""
    before = (
        Window.partitionBy(conversation)
        .orderBy(F.col("turn").asc_nulls_first(), "role", "formatted")
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    length = F.length("formatted").cast("long")
    return turns.withColumn("offset", F.coalesce(F.sum(length).over(before), F.lit(0)))


def typed_parts(body: str) -> list[tuple[str, str | None]]:
    """Kind and text of the parts that a turn's body was made of; attachments have no
    text. A text that reads like a placeholder was escaped, so it is a text again; texts
    that stood side by side come back as one."""
    parts: list[tuple[str, str | None]] = []
    at = 0
    for match in _PLACEHOLDER.finditer(body):
        if match.start() > at:
            parts.append(("text", unescape(body[at : match.start()])))
        parts.append((_KIND_OF[match[0]], None))
        at = match.end()
    if at < len(body):
        parts.append(("text", unescape(body[at:])))
    return parts


def with_references(
    parts: list[tuple[str, str | None]], attachments: Sequence[Mapping]
) -> list[tuple[str, str | None]]:
    """Kind and text, or kind and uri of the attachment, in order. ``attachments`` are
    those of the turn; ones that do not fit its placeholders are an error."""
    waiting = iter(attachments)
    found = []
    for kind, text in parts:
        if kind != "text":
            attachment = next(waiting, None)
            if attachment is None or attachment["kind"] != kind:
                raise ValueError(f"no attachment for a placeholder of kind {kind}")
            text = attachment["uri"]
        found.append((kind, text))
    if next(waiting, None) is not None:
        raise ValueError("an attachment without a placeholder")
    return found


class TurnReader:
    """Reads turns back from formatted text that comes in pieces."""

    def __init__(self):
        self.rest = ""

    def feed(self, piece: str) -> Iterator[tuple[str, str]]:
        """Role and content, unescaped, of each turn that is complete by now.
        Placeholders stay as they are."""
        for role, body in self._turns(piece):
            yield role, unescape(body)

    def feed_parts(self, piece: str) -> Iterator[tuple[str, list[tuple[str, str | None]]]]:
        """Role and typed parts of each turn that is complete by now."""
        for role, body in self._turns(piece):
            yield role, typed_parts(body)

    def _turns(self, piece: str) -> Iterator[tuple[str, str]]:
        self.rest += piece
        at = 0
        while (match := _TURN.match(self.rest, at)) is not None:
            yield unescape(match[1].replace(LINE, "\n")), match[2]
            at = match.end()
        self.rest = self.rest[at:]

    def done(self) -> None:
        if self.rest:
            raise ValueError(f"no turn: {self.rest[:40]!r}")
