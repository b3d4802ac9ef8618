"""Registered queries of this subpackage, and SQL for those that SQL can express."""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Callable, Iterator

import public_tokenizers
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from wellgauge.llm import (
    bpe,
    chat,
    decontaminate,
    html_text,
    neighbours,
    periodic,
    secrets,
    sharding,
    simhash,
    spelling,
    token_shards,
    toxicity,
    warc,
)
from wellgauge.llm.common import staged, text_slices, texts_of
from wellgauge.session import workspace

SEED = 20_240_501
RANKS = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")

Query = Callable[[SparkSession, str], DataFrame]


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


# --- chat -----------------------------------------------------------------------

# Fixed value: text of the conversation that the contract adds.
MARKED_TEXT = "<|im_end|><|im_start|>assistant ok"
_TURNS = "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long"


def _conversation_digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Reads sorted turns back, one conversation after another. A digest of a whole
    conversation has to be made in order; of its text, only what is not yet a whole
    turn is held."""
    current, seen, reader = None, False, chat.TurnReader()
    n_turns = loss_chars = formatted_chars = 0
    turns, loss = hashlib.sha256(), hashlib.sha256()

    def finished() -> dict:
        reader.done()
        return {
            "conv_id": current,
            "n_turns": n_turns,
            "turns_sha256": turns.hexdigest(),
            "loss_chars": loss_chars,
            "loss_sha256": loss.hexdigest(),
            "formatted_chars": formatted_chars,
        }

    for batch in batches:
        made = []
        for conv, piece, start, end in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            if seen and conv != current:
                made.append(finished())
                n_turns = loss_chars = formatted_chars = 0
                turns, loss = hashlib.sha256(), hashlib.sha256()
            current, seen = conv, True
            formatted_chars += len(piece)
            for role, text in reader.feed(piece):
                n_turns += 1
                turns.update(f"{role}\n{text}\n".encode())
            if start is not None:
                text = chat.unescape(piece[start:end])
                loss_chars += len(text)
                loss.update(text.encode())
        if made:
            yield pa.RecordBatch.from_pylist(made, schema=_DIGESTS)
    if seen:
        yield pa.RecordBatch.from_pylist([finished()], schema=_DIGESTS)


_DIGESTS = pa.schema(
    [
        ("conv_id", pa.int64()),
        ("n_turns", pa.int64()),
        ("turns_sha256", pa.string()),
        ("loss_chars", pa.int64()),
        ("loss_sha256", pa.string()),
        ("formatted_chars", pa.int64()),
    ]
)


def op1_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All conversations formatted, and read back from the formatted turns."""
    rows = _table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    marked = spark.createDataFrame(
        [(-1, 0, "user", MARKED_TEXT), (-1, 1, "assistant", MARKED_TEXT)],
        "conv_id long, turn long, role string, text string",
    )
    messages = rows.unionAll(marked).withColumn("content", chat.text_part(F.col("text")))
    return (
        chat.format_turns(messages)
        .repartition("conv_id")
        .sortWithinPartitions("conv_id", "turn", "role", "formatted")
        .select("conv_id", "formatted", "loss_start", "loss_end")
        .mapInArrow(_conversation_digests, _TURNS)
    )


# Fixed value: a text with marks, which is added as conversation -1.
TYPED_TEXT = "<|image|> seen\nx\nno <|audio|> here<|im_end|>\n\n<\\|document|>"
# What lines of a text stand for, in turn: every other one is an attachment.
_LINE_KINDS = ("image", "audio", "document")
_CHARACTERS_PER_UNIT = 100


def _line_parts(text: Column) -> Column:
    """Content of typed parts: lines of the text with attachments between them, which refer
    to the lines they stand for by a digest and grow with their length."""
    kinds = F.array(*map(F.lit, _LINE_KINDS))

    def part(line: Column, i: Column) -> Column:
        is_text = i % 2 == 0
        other = F.get(kinds, (F.floor(i / 2) % len(_LINE_KINDS)).cast("int"))
        units = F.floor(F.length(line) / _CHARACTERS_PER_UNIT).cast("int")
        return F.struct(
            F.when(is_text, "text").otherwise(other).alias("kind"),
            F.when(is_text, line).alias("text"),
            F.when(~is_text, F.concat(F.lit("md5:"), F.md5(line))).alias("uri"),
            F.when(~is_text, units).alias("units"),
        )

    return F.transform(F.split(F.coalesce(text, F.lit("")), "\n", -1), part)


def _part_digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Parts and references of each turn, read back from what it was formatted to."""
    for batch in batches:
        counts, references, digests, sizes = [], [], [], []
        formatted, attachments = batch.column("formatted"), batch.column("attachments")
        for i in range(batch.num_rows):
            reader, whole = chat.TurnReader(), formatted[i].as_py()
            ((role, parts),) = reader.feed_parts(whole)
            reader.done()
            parts = chat.with_references(parts, attachments[i].as_py())
            counts.append(len(parts))
            references.append(",".join(f"{kind} {uri}" for kind, uri in parts if kind != "text"))
            lines = [role, *(f"{kind}:{shown}" for kind, shown in parts)]
            digests.append(hashlib.sha256("\n".join(lines).encode()).hexdigest())
            sizes.append(len(whole))
        yield pa.RecordBatch.from_arrays(
            [
                *(batch.column(n) for n in ("conv_id", "turn", "role", "expanded_tokens")),
                pa.array(counts, pa.int64()),
                pa.array(references, pa.string()),
                pa.array(digests, pa.string()),
                pa.array(sizes, pa.int64()),
            ],
            names=[
                "conv_id", "turn", "role", "expanded_tokens",
                "n_parts", "attachments", "parts_sha256", "formatted_chars",
            ],
        )


def op1_chat_parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Typed parts of all messages: every other line of a text is an attachment. Per
    message, what is read back from its formatted turn: parts, references in order, tokens."""
    columns = [F.col("conv_id").cast("long"), F.col("turn").cast("long"), "role", "text"]
    rows = _table(spark, sf_dir, "conversations").select(*columns)
    marked = spark.createDataFrame(
        [(-1, 0, "user", TYPED_TEXT), (-1, 1, "assistant", TYPED_TEXT)],
        "conv_id long, turn long, role string, text string",
    )
    messages = rows.unionAll(marked).withColumn("content", _line_parts(F.col("text")))
    return chat.format_turns(messages).mapInArrow(
        _part_digests,
        "conv_id long, turn long, role string, expanded_tokens long, n_parts long, "
        "attachments string, parts_sha256 string, formatted_chars long",
    )


# --- byte-level BPE -------------------------------------------------------------


def _token_digests(batches: Iterator[pa.RecordBatch], rank_file: str) -> Iterator[pa.RecordBatch]:
    """Digests of what the operator's two halves give, batch by batch."""
    encoded = bpe.encode_batches(batches, rank_file, "doc_id", "text")
    for batch in bpe.decode_batches(encoded, rank_file):
        counts, digests = [], []
        for ids in batch.column("ids"):
            numbers = ids.values.to_numpy().tolist()
            counts.append(len(numbers))
            digests.append(hashlib.sha256(",".join(map(str, numbers)).encode()).hexdigest())
        decoded = [hashlib.sha256(b.as_buffer()).hexdigest() for b in batch.column("decoded")]
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), pa.array(counts, pa.int64()), digests, decoded],
            names=["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"],
        )


def op2_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every whole text encoded and decoded; both halves run in one pass, so ids
    need not travel between them."""
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    return docs.mapInArrow(
        lambda batches: _token_digests(batches, RANKS),
        "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string",
    )


# --- toxicity -------------------------------------------------------------------


def toxicity_scores(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Scores of ``docs`` by a model fitted on the labelled documents."""
    documents, labels = _table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels")
    model = toxicity.train(documents, labels, "toxic", split_yes=True)
    scored = toxicity.score(docs, model)
    return scored.withColumn("toxic", F.col("p_toxic") > 0.5)


def op3_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Expected severity of every document, in three grades."""
    return toxicity_scores(spark, _table(spark, sf_dir, "documents"), sf_dir)


# --- token shards ---------------------------------------------------------------


def op4_token_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The bytes of all documents as shards in training order, read back record by
    record."""
    docs = _table(spark, sf_dir, "documents")
    path = workspace(spark, "token-shards")
    shards = token_shards.write_shards(docs, path, seed=SEED, by_id=True)
    return _records_of(spark, shards)


def op4_bpe_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same with the ids of the 50k vocabulary, two bytes each. They are made once
    and staged."""
    encoded = bpe.encode(_table(spark, sf_dir, "documents"), RANKS).select("doc_id", "ids")
    shards = token_shards.write_shards(
        staged(encoded, "token-ids"),
        workspace(spark, "token-shards"),
        seed=SEED,
        by_id=True,
        ids_column="ids",
        width=2,
    )
    return _records_of(spark, shards)


def _records_of(spark: SparkSession, shards: token_shards.Shards) -> DataFrame:
    """All records with digests of their ids and the documents they hold parts of."""
    records = token_shards.read_shards(spark, shards).select(
        "slot",
        "shard",
        "position",
        "sequence",
        F.call_function("div", F.octet_length("ids"), F.lit(shards.width))
        .cast("long")
        .alias("n_ids"),
        F.sha2("ids", 256).alias("ids_sha256"),
    )
    return records.join(token_shards.documents_of(spark, shards), "sequence", "left").select(
        *records.columns, "doc_ids"
    )


# --- near-duplicates ------------------------------------------------------------


def op5_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprints of three-word shingles, linked at two bits or fewer."""
    docs = _table(spark, sf_dir, "documents")
    found = simhash.near_duplicates(docs, shingle=3, radius=2)
    digits = F.lower(F.lpad(F.hex("fp"), 16, "0"))
    return found.select("doc_id", digits.alias("fingerprint"), "component_id")


# --- sharding -------------------------------------------------------------------


def op6_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Eight shards whose row counts differ by one at most."""
    text = F.coalesce("text", F.lit(""))
    rows = _table(spark, sf_dir, "documents").select(
        "doc_id",
        (F.octet_length(text) + 1).cast("long").alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"),
    )
    return sharding.shard_rows(rows, ["doc_id", "size", "text_crc32"], 8, SEED).select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("rows").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )


# --- benchmark decontamination --------------------------------------------------


def op7_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Benchmark items found in documents, with their best window."""
    benchmark = _table(spark, sf_dir, "benchmark")
    return decontaminate.contaminations(_table(spark, sf_dir, "documents"), benchmark)


# --- nearest neighbours ---------------------------------------------------------


def op8_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ten nearest rows found for each hundredth vector."""
    found = neighbours.nearest(_table(spark, sf_dir, "embeddings"), "id % 100 = 0", k=10)
    return found.select(
        "query_id",
        "rank",
        F.col("neighbour_id").alias("vec_id"),
        F.col("distance").alias("score"),
    )


# --- secrets --------------------------------------------------------------------


def _joined(spans: Column) -> Column:
    return F.concat_ws(
        ",",
        F.transform(
            spans,
            lambda s: F.concat_ws(
                ":", s["kind"], s["start"].cast("string"), s["end"].cast("string")
            ),
        ),
    )


def op9_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Plain and structurally confirmed secrets of every document."""
    found = secrets.scan(_table(spark, sf_dir, "documents"))
    order = F.array(*map(F.lit, secrets.KINDS))
    every = F.array_sort(
        F.transform(
            F.concat("base", "structural"),
            lambda s: F.struct(
                s["start"], F.array_position(order, s["kind"]).alias("rank"), s["end"], s["kind"]
            ),
        )
    )

    def count(kind: str) -> Column:
        of_kind = F.filter("base", lambda s: s["kind"] == kind)
        return F.size(of_kind).cast("long").alias(f"n_{kind}")

    return found.select(
        "doc_id",
        count("assign"),
        count("access"),
        count("hex"),
        F.sha2(_joined(F.col("base")), 256).alias("base_sha256"),
        _joined(every).alias("spans"),
    )


# --- web archives ---------------------------------------------------------------


def op10_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages as legacy archives, converted to WARC files, and read back from these."""
    path = workspace(spark, "warc")
    warc.write_warc(warc.legacy_archives(_table(spark, sf_dir, "pages")), path)
    return warc.read_warc(spark, path).select(
        F.col("key").cast("long").alias("page_id"),
        "payload_bytes",
        "payload_digest",
        "record_type",
        F.col("refers_to").cast("long").alias("refers_to"),
    )


# --- spelling variants ----------------------------------------------------------


def _misspelt(word: Column) -> Column:
    """The contract's words: some lose a letter, by a checksum of document and word."""
    doc = F.coalesce(F.col("doc_id").cast("string"), F.lit(""))
    h = F.crc32(F.concat(doc, F.lit(":"), word).cast("binary"))
    at = (h % F.length(word)).cast("int")
    shorter = F.concat(F.left(word, at), F.substr(word, at + 2))
    return F.when(h % 199 == 0, shorter).otherwise(word)


def op11_spelling(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Frequent longer words of all documents with their near words, forms and roots."""
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    counted = spelling.word_counts(docs, changed=_misspelt)
    words = staged(counted.filter((F.length("word") >= 6) & (F.col("n") >= 5)), "spellings")
    return spelling.variants(words, ratio=5)


# --- page texts -----------------------------------------------------------------


def op12_page_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The main text of every page."""
    return html_text.extract(_table(spark, sf_dir, "pages"), ("page_id", "url"))


# --- periodic runs --------------------------------------------------------------


def _repeating(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The contract's texts: every tenth, by a checksum of its id, repeats some of its
    words to its end."""
    for batch in text_slices(batches):
        ids = batch.column("doc_id").to_pylist()
        texts = texts_of(batch)
        for row, doc_id in enumerate(ids):
            h = 1 if doc_id is None else zlib.crc32(str(doc_id).encode())
            words = texts[row].split() if h % 10 == 0 else []
            if words:
                n, g = len(words), h // 10
                a = g % n
                p = 1 + (n - a) // (3 + g % 8)
                texts[row] = b" ".join(words[:a] + [words[a + i % p] for i in range(n - a)])
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), pa.array(texts, pa.binary())], names=["doc_id", "text"]
        )


def _found_runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    return periodic.run_batches(_repeating(batches), "doc_id", "text")


def op13_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Runs of words in every document, and what is left without their repetitions."""
    found = (
        _table(spark, sf_dir, "documents")
        .select("doc_id", "text")
        .mapInArrow(
            _found_runs,
            "doc_id long, n_words long, "
            "runs array<struct<start: long, length: long, period: long>>, collapsed string",
        )
    )
    greatest = F.array_min(
        F.transform(
            "runs",
            lambda r: F.struct((-r["length"]).alias("less"), r["start"].alias("start"), r["period"].alias("period")),
        )
    )
    lines = F.transform(
        "runs", lambda r: F.concat(F.concat_ws(",", *(r[k].cast("string") for k in ("start", "length", "period"))), F.lit("\n"))
    )
    return found.withColumn("top", greatest).select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        "top.start",
        (-F.col("top.less")).alias("length"),
        "top.period",
        F.expr("-1000 * top.less div top.period").alias("exponent_milli"),
        F.sha2(F.array_join(lines, "").cast("binary"), 256).alias("runs_sha256"),
        F.sha2(F.col("collapsed").cast("binary"), 256).alias("collapsed_sha256"),
    )


# --- registry -----------------------------------------------------------------


def queries() -> dict[str, Query]:
    return {
        "op1_chat": op1_chat,
        "op1_chat_parts": op1_chat_parts,
        "op2_byte_bpe": op2_byte_bpe,
        "op3_toxicity": op3_toxicity,
        "op4_token_shards": op4_token_shards,
        "op4_bpe_shards": op4_bpe_shards,
        "op5_simhash": op5_simhash,
        "op6_sharding": op6_sharding,
        "op7_decontaminate": op7_decontaminate,
        "op8_neighbours": op8_neighbours,
        "op9_secrets": op9_secrets,
        "op10_warc": op10_warc,
        "op11_spelling": op11_spelling,
        "op12_page_text": op12_page_text,
        "op13_periodic_runs": op13_periodic_runs,
    }


def oracle_sql() -> dict[str, str]:
    def escaped(text: str) -> str:
        return rf"regexp_replace({text}, '<(\\*)\|', '<\1\\|', 'g')"

    # Turns of one number and role come in the order of what they read.
    shown = f"{escaped('text')} || '{chat.END}'"
    marks = len(chat.START) + len(chat.END) + 2
    typed = TYPED_TEXT.replace("\n", "' || chr(10) || '")
    kinds = ", ".join(f"'{kind}'" for kind in _LINE_KINDS)
    tokens = " ".join(f"WHEN '{k}' THEN {n}" for k, n in chat.TOKENS_PER_UNIT.items())
    return {
        "op1_chat": rf"""
            SELECT conv_id, count(*) AS n_turns,
                   sha256(string_agg(role || chr(10) || text || chr(10), ''
                                     ORDER BY turn, role, {shown})) AS turns_sha256,
                   CAST(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT)
                       AS loss_chars,
                   sha256(coalesce(string_agg(text, '' ORDER BY turn, role, {shown})
                                   FILTER (role = 'assistant'), '')) AS loss_sha256,
                   CAST(sum({marks} + length({escaped("role")}) + length({escaped("text")}))
                       AS BIGINT) AS formatted_chars
            FROM (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text
                  FROM conversations
                  UNION ALL SELECT -1, i, r, '{MARKED_TEXT}'
                  FROM (VALUES (0, 'user'), (1, 'assistant')) AS m(i, r))
            GROUP BY conv_id""",
        "op1_chat_parts": rf"""
            WITH messages AS (
                SELECT row_number() OVER () AS id, conv_id, turn, coalesce(role, '') AS role,
                       string_split(coalesce(text, ''), chr(10)) AS lines
                FROM (SELECT conv_id, turn, role, text FROM conversations
                      UNION ALL SELECT -1, i, r, '{typed}'
                      FROM (VALUES (0, 'user'), (1, 'assistant')) AS m(i, r))),
            numbered AS (
                SELECT id, unnest(lines) AS line, generate_subscripts(lines, 1) - 1 AS i
                FROM messages),
            parts AS (
                SELECT id, i, line, CASE WHEN i % 2 = 0 THEN 'text'
                           ELSE [{kinds}][1 + (i // 2) % {len(_LINE_KINDS)}] END AS kind
                FROM numbered WHERE i % 2 = 1 OR line <> ''),
            shown AS (
                SELECT id, i, kind, CASE kind {tokens} ELSE 0 END
                           * greatest(length(line) // {_CHARACTERS_PER_UNIT}, 1) AS tokens,
                       CASE kind WHEN 'text' THEN line ELSE 'md5:' || md5(line) END AS body,
                       CASE kind WHEN 'text' THEN length({escaped("line")})
                                 ELSE length(kind) + 4 END AS chars
                FROM parts)
            SELECT conv_id, CAST(turn AS BIGINT) AS turn, role,
                   CAST(coalesce(sum(tokens), 0) AS BIGINT) AS expanded_tokens,
                   count(shown.id) AS n_parts,
                   coalesce(string_agg(kind || ' ' || body, ',' ORDER BY i)
                            FILTER (kind <> 'text'), '') AS attachments,
                   sha256(role || coalesce(string_agg(chr(10) || kind || ':' || body, ''
                                                      ORDER BY i), '')) AS parts_sha256,
                   CAST({marks} + length({escaped("role")}) + coalesce(sum(chars), 0) AS BIGINT)
                       AS formatted_chars
            FROM messages LEFT JOIN shown USING (id)
            GROUP BY messages.id, conv_id, turn, role""",
        "op10_warc": """
            SELECT page_id, payload_bytes, payload_digest,
                   CASE WHEN page_id > first THEN 'revisit' ELSE 'response' END AS record_type,
                   CASE WHEN page_id > first THEN first END AS refers_to
            FROM (SELECT *, CASE WHEN payload_bytes >= 100 THEN
                             min(page_id) OVER (PARTITION BY payload_digest) END AS first
                  FROM (SELECT page_id, octet_length(encode(coalesce(html, ''))) AS payload_bytes,
                               sha256(coalesce(html, '')) AS payload_digest FROM pages))""",
        # Articles are marked in the given pages, and hold these references only.
        "op12_page_text": r"""
            SELECT page_id, url, text, length(text) AS n_chars
            FROM (SELECT page_id, url, trim(regexp_replace(
                      regexp_replace(replace(replace(replace(replace(
                          regexp_replace(regexp_extract(html, '(?s)<article>(.*)</article>', 1),
                                         '<[^>]*>', ' ', 'g'),
                          '&quot;', '"'), '&#x27;', chr(39)), '&lt;', '<'), '&gt;', '>'),
                          '&amp;?', '&', 'g'), '\s+', ' ', 'g')) AS text
                  FROM pages)""",
    }
