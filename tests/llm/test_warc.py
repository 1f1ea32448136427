import hashlib
from collections import Counter

import brute

from isobar.llm.warc import GAP, VERSION, pages_from_records, read_warc, write_warc

TRAP = f"{VERSION}WARC-Type: response\r\nContent-Length: 3{GAP}abc{GAP}{VERSION}"


def pages(spark):
    rows = [(r[0], r[1], r[2]) for r in brute.sample(spark, 50, "pages")]
    rows += [(5000 + i, u, h) for i, u, h in rows[:20]]
    rows += [(6000 + k, "trap", f"{'x' * 150}{TRAP * (k + 1)}y{k}") for k in range(4)]
    rows += [(None, None, None), (None, "q", "z" * 200), (7, "a\r\nb", ""), (8, "ü", "é"), (8, "ü", "é"), (9000, "same", "s" * 150), (9000, "same", "s" * 150)]
    rows += [(9001, "long", "long " * 60_000), (None, "none", "n" * 120), (None, "none", "n" * 120), (9100, "m", VERSION * 30)]
    return rows


def expected(rows):
    body = [(i, (h or "").encode()) for i, _, h in rows]
    least = {}
    for i, b in body:
        if len(b) >= 100 and i is not None:
            least[b] = min(i, least.get(b, i))
    out = Counter()
    for i, b in body:
        again = b in least and least[b] != i
        out[i, len(b), hashlib.sha256(b).hexdigest(), "revisit" if again else "response", least[b] if again else None] += 1
    return out


def test_round_trip(spark, tmp_path):
    rows = pages(spark)
    df = spark.createDataFrame([(*r, "x", 1) for r in rows], "page_id long, url string, html string, digest string, size int")
    for name, part in (("whole", "64m"), ("parts", "20k")):
        spark.conf.set("spark.sql.files.maxPartitionBytes", part)
        try:
            write_warc(df, f"{tmp_path}/{name}")
            got = pages_from_records(read_warc(spark, f"{tmp_path}/{name}")).collect()
        finally:
            spark.conf.unset("spark.sql.files.maxPartitionBytes")
        assert Counter((r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in got) == expected(rows)


def test_one_file_in_many_parts(spark, tmp_path):
    rows = pages(spark) * 3
    df = spark.createDataFrame(rows, "page_id long, url string, html string").coalesce(1)
    write_warc(df, f"{tmp_path}/a", min_revisit=1 << 40)
    spark.conf.set("spark.sql.files.maxPartitionBytes", "30k")
    try:
        got = read_warc(spark, f"{tmp_path}/a").collect()
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    want = Counter(hashlib.sha256((h or "").encode()).hexdigest() for _, _, h in rows)
    assert Counter(r.payload_digest for r in got) == want and all(r.payload_digest == r.stated for r in got)


def test_damage_ends_the_chain(spark, tmp_path):
    good = b"".join(
        VERSION.encode() + f"WARC-Type: resource\r\nContent-Length: {len(b)}{GAP}".encode() + b + GAP.encode() for b in (b"one", b"\xff\xfe raw", b"three")
    )
    (tmp_path / "w").mkdir()
    (tmp_path / "w/a.warc").write_bytes(good)
    (tmp_path / "w/b.warc").write_bytes(good[:-20] + good)
    (tmp_path / "w/c.warc").write_bytes(b"junk" + good)
    got = Counter((r.file.rsplit("/", 1)[1], r.payload_digest) for r in read_warc(spark, str(tmp_path / "w")).collect())
    digest = [hashlib.sha256(b).hexdigest() for b in (b"one", b"\xff\xfe raw", b"three")]
    assert {d for f, d in got if f == "a.warc"} == set(digest)
    assert {d for f, d in got if f == "b.warc"} == set(digest[:2])
    assert not [f for f, _ in got if f == "c.warc"]


def test_empty_table(spark, tmp_path):
    write_warc(spark.createDataFrame([], "page_id long, url string, html string"), f"{tmp_path}/e")
    assert pages_from_records(read_warc(spark, f"{tmp_path}/e")).count() == 0
