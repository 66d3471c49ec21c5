"""Rows of a batch are written in parts, of which only one is on its way at a time; shards, numbers and rows are those of one part."""

import pytest
from test_ledger import SIZES, batches, plainly, published, rows_of

from colloquy.operators import labels, rows
from colloquy.params import TrackParams
from colloquy.plans.tracks import plan
from colloquy.session import work_path
from colloquy.sinks import ledger as ledger_module
from colloquy.sinks.ledger import Ledger
from colloquy.sources import adapters
from colloquy.streaming import incremental

P = TrackParams()


@pytest.mark.parametrize(("cuts", "part_rows"), [((), 7), ((30, 31, 60), 10), ((50,), 1)])
def test_shards_do_not_depend_on_parts(spark, tmp_path, monkeypatch, cuts, part_rows):
    writes = []
    monkeypatch.setattr(ledger_module, "write_dealt", lambda *a, _write=ledger_module.write_dealt, **k: (writes.append(1), _write(*a, **k)))
    ledger = Ledger(spark, f"{tmp_path}/t", 1_000, 125)
    for n, part in enumerate(batches(*cuts)):
        made, sizes = rows_of(spark, part)
        assert ledger.append(n, made.where if n % 2 else made, sizes, part_rows=part_rows)
    ledger.finish()
    assert published(ledger) == plainly()
    assert len(writes) > 3 + len(cuts)
    files = ledger.manifest()
    assert files.count() == files.select("shard").distinct().count() == len({s for _, s, *_ in plainly()})  # one file a shard
    assert ledger.vacuum() == [] and sum(r["tracks"] for r in files.collect()) == len(SIZES)


def test_streams_write_batches_in_parts(spark, small, monkeypatch):
    utterances = adapters.document_utterances(spark, small)
    requests = adapters.track_requests(spark, small).where("track_id < 60")
    made = plan(utterances, requests, P)
    want = sorted(map(str, rows.track_rows(labels.with_text(made.turns, utterances), P).collect()))
    n_turns = made.turns.count()
    monkeypatch.setattr(incremental, "_PART_TURNS", -(-n_turns // 3))
    asked = []
    monkeypatch.setattr(rows, "track_rows_with_texts", lambda *a, _rows=rows.track_rows_with_texts: (asked.append(a[-1]), _rows(*a))[1])
    folder = work_path(spark, "requests")
    requests.coalesce(1).write.parquet(folder)

    def stream():
        return incremental.stream_requests(spark, folder, "part-*", "track_id bigint", "track_id")

    out = work_path(spark, "stream")
    incremental.generate_incrementally(stream(), utterances, out, work_path(spark, "state"), P)
    found = incremental.incremental_rows(spark, out).drop("batch_no")
    assert sorted(map(str, found.collect())) == want
    assert asked == [n_turns // 3] * 3

    ledger = Ledger(spark, work_path(spark, "published"), 32 << 20)
    incremental.publish_incrementally(stream(), utterances, ledger, work_path(spark, "state"), P)
    assert sorted(map(str, ledger.read().select(*found.columns).collect())) == want
    assert len(asked) >= 5 and [r[0] for r in ledger.read().select("track_no").orderBy("track_no").collect()] == list(range(len(want)))
