"""Tracks are mixed from batches, wherever a batch ends, and texts travel to their tracks once."""

from pyspark.sql import functions as F
from test_growth import settings

from colloquy.operators import labels, rows, waveforms
from colloquy.params import TrackParams
from colloquy.plans import catalog
from colloquy.plans.tracks import plan
from colloquy.sources import adapters


def mixed(spark, small, batch):
    source = adapters.embedding_waves(spark, small)
    turns = plan(source, adapters.track_requests(spark, small).where("track_id < 40"), catalog.NOISY_WAVES).turns
    with settings(spark, **{"spark.sql.execution.arrow.maxRecordsPerBatch": str(batch)}):
        made = waveforms.build_waveforms(turns, source, catalog.NOISY_WAVES)
        assert "FlatMapGroups" not in made._jdf.queryExecution().executedPlan().toString()
        return sorted((r["track_id"], r["audio"], r["snr"]) for r in made.collect())


def test_tracks_do_not_depend_on_batches(spark, small):
    found = mixed(spark, small, 3)
    assert len(found) == 40
    assert found == mixed(spark, small, 10_000)


def test_texts_are_dealt_by_track_before_they_are_nested(spark, small):
    params = TrackParams()
    made = plan(adapters.document_utterances(spark, small), adapters.track_requests(spark, small), params)
    texts = labels.with_text(made.turns, made.utterances)
    dealt = rows.track_rows(texts, params, 300_000)
    assert dealt.rdd.getNumPartitions() == 15
    plain = rows.track_rows(texts, params)
    assert sorted(map(str, dealt.collect())) == sorted(map(str, plain.collect()))
