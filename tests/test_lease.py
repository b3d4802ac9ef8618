"""One run at a time over the same tables."""

import json
import time
from pathlib import Path
from threading import Thread

import pytest

from samples import message
from wellgauge import JobConfig, MessageSource
from wellgauge.plans import Lease, LeaseHeld, job, run_job
from wellgauge.sources import stream_messages


def messages_of(spark, log, *texts):
    return stream_messages(spark, MessageSource("parquet", {"path": log(texts)}))


def test_an_overlapping_run_ends_with_an_error(spark, config, log, monkeypatch):
    errors = []
    enrich = job.enrich

    def overlapped(*arguments):
        with pytest.raises(LeaseHeld) as raised:
            run_job(spark, config, messages_of(spark, log, message()))
        errors.append(raised.value)
        enrich(*arguments)

    with monkeypatch.context() as patch:
        patch.setattr(job, "enrich", overlapped)
        run_job(spark, config, messages_of(spark, log, message()))
    assert len(errors) == 1
    run_job(spark, config, messages_of(spark, log, message()))  # it was given back


def test_a_failed_run_gives_its_lease_back(spark, config, log, monkeypatch):
    def fail(*_):
        raise OSError("no space")

    with monkeypatch.context() as patch:
        patch.setattr(job, "enrich", fail)
        with pytest.raises(OSError):
            run_job(spark, config, messages_of(spark, log, message()))
    run_job(spark, config, messages_of(spark, log, message()))


def test_a_stale_lease_is_taken_over(spark, tmp_path):
    folder = tmp_path / "lease"
    folder.mkdir()
    (folder / "4").write_text(json.dumps({"owner": "dead", "until": time.time() + 60}))
    with pytest.raises(LeaseHeld), Lease(spark, str(folder), 60):
        pass
    (folder / "4").write_text(json.dumps({"owner": "dead", "until": time.time() - 1}))
    with Lease(spark, str(folder), 60) as lease:
        lease.check()
        assert json.loads((folder / "5").read_text())["until"] > time.time() + 30
    assert json.loads((folder / "5").read_text())["until"] <= time.time()


def test_of_many_that_try_at_once_one_gets_it(spark, tmp_path):
    folder, won = str(tmp_path / "lease"), []

    def attempt():
        try:
            with Lease(spark, folder, 30):
                won.append(1)
                time.sleep(3)
        except LeaseHeld:
            pass

    threads = [Thread(target=attempt) for _ in range(8)]
    for t in threads:
        t.start()
    for t in threads:
        t.join()
    assert len(won) == 1


def test_a_lease_is_renewed_and_its_loss_is_told(spark, tmp_path):
    folder = tmp_path / "lease"
    with Lease(spark, str(folder), 1.5) as lease:
        time.sleep(3)
        lease.check()
        with pytest.raises(LeaseHeld), Lease(spark, str(folder), 1.5):
            pass
        (folder / "1").write_text(json.dumps({"owner": "other", "until": time.time() + 60}))
        time.sleep(1.5)
        with pytest.raises(LeaseHeld):
            lease.check()
    # What another run holds is left alone.
    assert json.loads((folder / "1").read_text())["owner"] == "other"


def test_old_leases_do_not_pile_up(spark, config, tmp_path):
    for _ in range(5):
        with Lease(spark, config.lease_path, 60):
            pass
    assert len([p for p in Path(config.lease_path).iterdir() if p.name.isdigit()]) == 2
    assert JobConfig(config.layout).lease_seconds == 600
