import pytest
from messages import FREE_WEATHER, OPEN_METEO, OPEN_WEATHER, free, log, meteo, open_weather, record

from isobar.operators.reshape import message_id, provider_documents
from isobar.schemas import TOPICS
from isobar.sources.messages import parse_envelopes, stream_landed
from isobar.streaming.first_write import SHARES, start_first_write
from isobar.streaming.stores import document_schema, read_documents


@pytest.fixture
def store(spark, tmp_path):
    """Lands records and drains them by the query of one topic and checkpoint; reads what is stored."""

    class Store:
        folder = f"{tmp_path}/store"

        def put(self, *records, topic=OPEN_WEATHER, checkpoint="c1", known=None, source="in"):
            if records:
                log(spark, *records).coalesce(1).write.mode("append").parquet(f"{tmp_path}/{source}")
            start_first_write(stream_landed(spark, f"{tmp_path}/{source}"), topic, self.folder, f"{tmp_path}/{checkpoint}", known).awaitTermination()

        def read(self, topic=OPEN_WEATHER):
            return read_documents(spark, f"{self.folder}/{topic}", document_schema(provider_documents(log(spark), topic)))

    return Store()


TEMP = "current_weather.main.temp"


def test_first_record_of_an_id_wins(spark, rows, store):
    store.put(
        record(OPEN_WEATHER, open_weather(301.0), 5),
        record(OPEN_WEATHER, open_weather(300.0), 3),
        record(OPEN_WEATHER, open_weather(309.0), 1, partition=1),
        record(OPEN_WEATHER, "{broken", 9),
        record(OPEN_WEATHER, "{broken", 10),
        record(FREE_WEATHER, free(20.0), 0),
    )
    assert rows(store.read(), TEMP, "partition", "offset") == [(300.0, 0, 3)]
    store.put(record(OPEN_WEATHER, open_weather(305.0), 11), record(OPEN_WEATHER, open_weather(306.0, dt=1930793402), 12))
    assert sorted(rows(store.read(), TEMP)) == [(300.0,), (306.0,)]
    assert sorted(rows(spark.read.parquet(f"{store.folder}/_quarantine/{OPEN_WEATHER}"), "offset")) == [(9,), (10,)]


def test_a_new_checkpoint_starts_from_the_stored_ids(spark, rows, store):
    store.put(record(OPEN_WEATHER, open_weather(300.0), 0))
    store.put(record(OPEN_WEATHER, open_weather(301.0), 1), record(OPEN_WEATHER, open_weather(302.0, dt=5), 2), checkpoint="c2", known=store.read())
    assert sorted(rows(store.read(), TEMP)) == [(300.0,), (302.0,)]
    # The ids go on in the state of the second checkpoint.
    store.put(record(OPEN_WEATHER, open_weather(303.0), 3), record(OPEN_WEATHER, open_weather(304.0, dt=5), 4), checkpoint="c2", known=store.read())
    assert sorted(rows(store.read(), TEMP)) == [(300.0,), (302.0,)]


def test_a_batch_reads_no_stored_row(spark, rows, store, tmp_path):
    store.put(record(OPEN_WEATHER, open_weather(300.0), 0))
    # A batch that read the store would fail on this file.
    day = next((tmp_path / "store" / OPEN_WEATHER).glob("id_date=*"))
    (day / "run=x").mkdir()
    (day / "run=x" / "batch=7").mkdir()
    (day / "run=x" / "batch=7" / "part-0.parquet").write_bytes(b"no parquet")
    store.put(record(OPEN_WEATHER, open_weather(301.0), 1), record(OPEN_WEATHER, open_weather(302.0, dt=1930789803), 2))
    (day / "run=x" / "batch=7" / "part-0.parquet").write_bytes(b"")
    stored = spark.read.parquet(*[str(p) for p in day.glob("run=*") if p.name != "run=x"])
    assert sorted(rows(stored, TEMP)) == [(300.0,), (302.0,)]


def test_ids_equal_those_of_the_documents(spark, rows):
    records = log(
        spark,
        record(FREE_WEATHER, free(20.0), 0),
        record(OPEN_WEATHER, open_weather(300.0), 0),
        record(OPEN_METEO, meteo(27.0), 0),
    )
    for topic in TOPICS:
        assert rows(parse_envelopes(records, topic).select(message_id(topic))) == rows(provider_documents(records, topic), "_id")


def test_time_to_live(spark, rows, tmp_path):
    """An id is forgotten when the log has gone on by a day, also one that was known at the start."""
    source, store = f"{tmp_path}/in", f"{tmp_path}/store"
    schema = document_schema(provider_documents(log(spark), OPEN_WEATHER))
    known = spark.createDataFrame(
        [("x", None)], "_id STRING, id_time TIMESTAMP"
    ).unionByName(provider_documents(log(spark, record(OPEN_WEATHER, open_weather(1.0, dt=1930789000), 0)), OPEN_WEATHER).select("_id", "id_time"))

    def put(*records):
        log(spark, *records).coalesce(1).write.mode("append").parquet(source)
        query = start_first_write(stream_landed(spark, source), OPEN_WEATHER, store, f"{tmp_path}/c", known, "1 day")
        assert query.awaitTermination(60)

    put(record(OPEN_WEATHER, open_weather(300.0, dt=1930789000), 0), record(OPEN_WEATHER, open_weather(301.0), 1))
    put(record(OPEN_WEATHER, open_weather(302.0), 2, "2031-03-09 20:00:00"))
    put(record(OPEN_WEATHER, open_weather(303.0, dt=9), 3, "2031-03-12 00:00:00"))
    put(record(OPEN_WEATHER, open_weather(304.0), 4, "2031-03-12 00:00:01"), record(OPEN_WEATHER, open_weather(305.0, dt=1930789000), 5, "2031-03-12 00:00:01"))
    assert sorted(rows(read_documents(spark, f"{store}/{OPEN_WEATHER}", schema), TEMP)) == [(301.0,), (303.0,), (304.0,), (305.0,)]
    state = spark.read.format("statestore").option("path", f"{tmp_path}/c/{OPEN_WEATHER}").option("stateVarName", "seen").load()
    assert state.count() == 3


def test_ids_of_an_hour_share_states(spark, rows, store, tmp_path):
    """State has a row per bucket and not per id, in as many stores as there are cores at most."""
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "24")
    try:
        store.put(*[record(OPEN_WEATHER, open_weather(300.0 + k, dt=1930788000 + k % 60), k) for k in range(120)])
        assert spark.conf.get("spark.sql.shuffle.partitions") == "24"
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    assert sorted(rows(store.read(), "offset")) == [(k,) for k in range(60)]
    state = spark.read.format("statestore").option("path", f"{tmp_path}/c1/{OPEN_WEATHER}").option("stateVarName", "seen")
    assert state.load().count() == 60
    assert state.option("flattenCollectionTypes", "false").load().count() <= SHARES
    assert '"spark.sql.shuffle.partitions":"8"' in (tmp_path / "c1" / OPEN_WEATHER / "offsets" / "0").read_text()
