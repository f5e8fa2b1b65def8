import json
import os

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tallyfold import state
from tallyfold.schemas import COMMENT
from tallyfold.sources import batches, budget, config, paged, readers, writers, zstd
from tallyfold.streaming import ingest
from tallyfold.operators.matching import Name


class Free:
    """A gate that is open."""

    def enter(self):
        pass

    def seen(self, headers):
        pass


FREE = Free()


def lines(n, **more):
    return [json.dumps({"id": str(k), "body": f"b{k} curry", "created_utc": 1704067200 + 86400 * k, "x": 1} | more) for k in range(n)]


def test_tolerant_jsonl(spark, tmp_path):
    f = tmp_path / "a.jsonl"
    f.write_text("\n".join([*lines(3), "", "nope", '{"id": "9', "[1]"]))
    got = readers.jsonl(spark, str(f), COMMENT)
    assert sorted(r["id"] for r in got.collect()) == ["0", "1", "2"] and got.columns == COMMENT.names
    assert tuple(readers.jsonl_stats(spark, str(f)).first()) == (6, 2)


def test_zstd_keeps_the_last_line_and_multibyte_characters(spark, tmp_path):
    import zstandard

    text = "\n".join(["é🏀" * 5000 for _ in range(50)] + ["", "last"])
    (tmp_path / "a.zst").write_bytes(zstandard.ZstdCompressor().compress(text.encode()))
    got = [r["value"] for r in readers.zstd_lines(spark, str(tmp_path / "*.zst")).collect()]
    assert len(got) == 51 and got[-1] == "last" and all("\ufffd" not in x for x in got)


def test_zstd_frames_are_read_in_parallel(spark, tmp_path):
    """Lines over the ends of frames, at them, without newlines in whole frames; frames with and without checksum and size; skippable ones."""
    import io as bytes_io
    import random

    import zstandard

    r = random.Random(3)
    for trial in range(25):
        text = "\n".join("".join(r.choice("aé🏀 ") for _ in range(r.choice((0, 1, 3, 40, 400)))) for _ in range(r.randrange(1, 60)))
        data, raw = text.encode() + (b"\n" if trial % 3 else b""), b""
        while data:
            n = r.choice((1, 2, 7, 60, 300))
            piece, data = data[:n], data[n:]
            raw += zstandard.ZstdCompressor(write_checksum=bool(r.randrange(2)), write_content_size=bool(r.randrange(2))).compress(piece)
            if r.random() < 0.2:
                raw += (0x184D2A50 + r.randrange(16)).to_bytes(4, "little") + (5).to_bytes(4, "little") + b"hello"
        want = [x.strip() for x in text.split("\n") if x.strip()]
        for most in (1, 50, 200, 10**9):
            parts = zstd.runs(bytes_io.BytesIO(raw), "f", len(raw), most)
            assert [p.start for p in parts[1:]] == [p.end for p in parts[:-1]] and parts[-1].end == len(raw)
            assert [x for p in parts for some in zstd.lines(bytes_io.BytesIO(raw), p) for x in some] == want
        if trial < 3:
            (tmp_path / f"{trial}.zst").write_bytes(raw)
            found = readers.zstd_lines(spark, f"file://{tmp_path}/{trial}.zst", run=100)
            assert sorted(x["value"] for x in found.collect()) == sorted(want)
    assert found.rdd.getNumPartitions() > 3


def test_zstd_memory_is_a_chunk(tmp_path):
    """A single frame of 300 MB of text."""
    import tracemalloc

    import zstandard

    with open(tmp_path / "big.zst", "wb") as f, zstandard.ZstdCompressor(level=1).stream_writer(f) as w:
        for k in range(300):
            w.write((f"line {k} " + "x" * 90 + "\n").encode() * 10_000)
    n = 0
    tracemalloc.start()
    with open(tmp_path / "big.zst", "rb") as f:
        (run,) = zstd.runs(f, "f", os.path.getsize(tmp_path / "big.zst"))
        for some in zstd.lines(f, run):
            n += len(some)
    assert n == 3_000_000 and tracemalloc.get_traced_memory()[1] < 100 << 20
    tracemalloc.stop()


def test_zstd_files_are_written_in_frames(spark, tmp_path):
    rows = spark.range(5000).select(F.format_string("line %d é", "id").alias("value")).repartition(3)
    writers.zstd_lines(rows, str(tmp_path / "z"), frame=2000)
    writers.zstd_lines(rows.limit(10), str(tmp_path / "z"), frame=2000, append=True)
    names = sorted(p.name for p in (tmp_path / "z").iterdir())
    assert len(names) == 4 and all(n.startswith("part-") for n in names)
    assert readers.zstd_lines(spark, str(tmp_path / "z")).count() == 5010
    writers.zstd_lines(rows.limit(7), str(tmp_path / "z"))
    assert readers.zstd_lines(spark, str(tmp_path / "z")).count() == 7


def test_writers_round_trip(spark, tmp_path):
    df = spark.createDataFrame([("a", 1), ("b", None)], "k string, n long")
    writers.parquet(df, str(tmp_path / "p"))
    writers.jsonl(df, str(tmp_path / "j"))
    writers.jsonl(df, str(tmp_path / "j"), append=True)
    writers.csv(df, str(tmp_path / "c"))
    assert readers.parquet(spark, str(tmp_path / "p")).count() == 2
    assert readers.jsonl(spark, str(tmp_path / "j"), df.schema).count() == 4
    assert {tuple(r) for r in readers.csv(spark, str(tmp_path / "c"), df.schema).collect()} == {("a", 1), ("b", None)}


def test_document(spark, tmp_path):
    import datetime as dt

    df = spark.createDataFrame([("a", dt.date(2024, 1, 1))], "k string, d date")
    writers.document({"rows": df, "meta": df}, str(tmp_path / "x" / "d.json"), single=("meta",))
    doc = json.loads((tmp_path / "x" / "d.json").read_text())
    assert doc == {"rows": [{"k": "a", "d": "2024-01-01"}], "meta": {"k": "a", "d": "2024-01-01"}}
    from pyspark.sql import types as T

    schema = T.StructType([T.StructField("rows", T.ArrayType(T.StructType([T.StructField("k", T.StringType()), T.StructField("d", T.StringType())])))])
    assert readers.json_document(spark, str(tmp_path / "x" / "d.json"), schema, "rows").first()["k"] == "a"


def test_document_refuses_large_views(spark, tmp_path):
    with pytest.raises(ValueError, match="more than 3 rows"):
        writers.document({"rows": spark.range(10)}, str(tmp_path / "d.json"), limit=3)


def test_batch_files(spark, tmp_path):
    folder = tmp_path / "b"
    folder.mkdir()
    (folder / "batch_007.jsonl").write_text("of an earlier run")
    (folder / "notes.txt").write_text("stay")
    batches.write(spark.range(25), str(folder), "id", 10)
    assert sorted(p.name for p in folder.iterdir()) == ["batch_001.jsonl", "batch_002.jsonl", "batch_003.jsonl", "notes.txt"]
    assert [json.loads(x)["id"] for x in (folder / "batch_002.jsonl").read_text().splitlines()] == list(range(10, 20))
    batches.write(spark.range(1), f"file://{folder}", "id", 10)
    assert [os.path.basename(f) for f in batches.files(str(folder))] == ["batch_001.jsonl"]
    batches.write(spark.range(0), str(tmp_path / "none"), "id", 10)
    assert batches.files(str(tmp_path / "none")) == []


def test_attempts_that_failed_leave_no_batch(tmp_path):
    def rows(*pairs):
        return iter([pa.RecordBatch.from_arrays([pa.array([n for n, _ in pairs]), pa.array([v for _, v in pairs])], names=["batch_num", "value"])])

    def breaks():
        yield from rows((1, "a"), (2, "b"))
        raise OSError("the executor is lost")

    w = batches.BatchFileWriter(str(tmp_path))
    with pytest.raises(OSError):
        w.write(breaks())
    again, twice, other = w.write(rows((1, "a"), (1, "c"), (2, "b"))), w.write(rows((1, "a"), (1, "c"), (2, "b"))), w.write(rows((12, "é")))
    assert batches.files(str(tmp_path)) == []
    w.commit([again, None, other])
    assert twice.batches != again.batches
    assert {p.name: p.read_text() for p in tmp_path.iterdir()} == {"batch_001.jsonl": "a\nc\n", "batch_002.jsonl": "b\n", "batch_012.jsonl": "é\n"}
    w = batches.BatchFileWriter(str(tmp_path))
    w.write(rows((1, "new")))
    w.abort([])
    assert (tmp_path / "batch_001.jsonl").read_text() == "a\nc\n" and len(list(tmp_path.iterdir())) == 3
    w = batches.BatchFileWriter(str(tmp_path))
    with pytest.raises(ValueError, match="two tasks"):
        w.commit([w.write(rows((1, "x"))), w.write(rows((1, "y")))])
    with pytest.raises(ValueError, match="together"):
        w.write(rows((1, "x"), (2, "y"), (1, "z")))


def test_names_of_batches():
    assert [batches.file_name(n) for n in (1, 12, 1234)] == ["batch_001.jsonl", "batch_012.jsonl", "batch_1234.jsonl"]
    assert batches.in_order(["d/batch_1000.jsonl", "x", "d/batch_999.jsonl", "d/batch_2.jsonl", "a"]) == ["d/batch_2.jsonl", "d/batch_999.jsonl", "d/batch_1000.jsonl", "a", "x"]


def test_results_and_split(spark, tmp_path):
    ok = {"custom_id": "1", "result": {"type": "succeeded", "message": {"content": [{"text": "x"}], "usage": {"input_tokens": 3, "output_tokens": 2}}}}
    empty = {"custom_id": "2", "result": {"type": "succeeded", "message": {"content": []}}}
    bad = {"custom_id": "3", "result": {"type": "expired"}}
    (tmp_path / "batch_001_results.jsonl").write_text("\n".join(map(json.dumps, (ok, empty, bad))))
    got = readers.batch_results(spark, str(tmp_path / "batch_*_results.jsonl"))
    assert {(r["custom_id"], r["result_type"], r["content"], r["input_tokens"]) for r in got.collect()} == {("1", "succeeded", "x", 3), ("2", "errored", None, None), ("3", "expired", None, None)}
    writers.split_results(got, str(tmp_path / "good"), str(tmp_path / "dead"))
    assert spark.read.parquet(str(tmp_path / "good")).count() == 1 and spark.read.json(str(tmp_path / "dead")).count() == 2
    assert tuple(readers.rows_per_file(spark, str(tmp_path / "*.jsonl")).first()) == ("batch_001_results.jsonl", 3)


def test_config(spark, tmp_path):
    (tmp_path / "p.yaml").write_text("short_aliases: [ad, zz]\nplayers:\n  A D:\n    aliases: [ad]\n    team: Red\n    player_id: 3\n  B:\n    - bee\n")
    e = config.entities(str(tmp_path / "p.yaml"))
    assert [n.name for n in e.names] == ["A D", "B"] and e.short == {"ad", "zz"} and e.problems() == ["zz: no name has this alias"]
    assert {tuple(r)[:2] for r in e.table(spark).collect()} == {("A D", "Red"), ("B", None)}
    assert config.entities(str(tmp_path / "p.yaml")) is e
    (tmp_path / "t.yaml").write_text("teams:\n  Red:\n    abbreviation: RD\n    conference: East\n    team_id: 1\n    aliases: [reds]\n")
    assert config.teams(str(tmp_path / "t.yaml")).table(spark).first()["abbreviation"] == "RD"
    (tmp_path / "s.yaml").write_text("season: 2024-25\nstart_date: '2024-10-01'\nend_date: '2025-06-30'\nsubreddits: [nba]\n")
    assert config.season(str(tmp_path / "s.yaml")).sources == ("nba",)
    (tmp_path / "bad.yaml").write_text("season: x\nsubreddits: []\n")
    with pytest.raises(ValueError, match="start_date"):
        config.season(str(tmp_path / "bad.yaml"))
    assert config.epoch_bounds("1970-01-02", "1970-01-03") == (86400, 172800)
    assert config.Paths("s", "/d").state().as_posix() == "/d/s/batches/state.json"


@pytest.mark.parametrize(
    ("headers", "wait"), [({}, 0), ({"X-RateLimit-Remaining": "50"}, 0), ({"X-RateLimit-Remaining": "5", "X-RateLimit-Reset": "110"}, 11), ({"X-RateLimit-Remaining": "5"}, 60), ({"X-RateLimit-Remaining": "0", "X-RateLimit-Reset": "1"}, 1)]
)
def test_rate_limit(headers, wait):
    assert budget.wait_for(headers, 100) == wait


@pytest.mark.parametrize("same_second", [1, 3, 40])
def test_pages_lose_nothing(monkeypatch, same_second):
    from urllib.parse import parse_qs, urlparse

    monkeypatch.setattr(paged, "PAGE", 50)
    items = [{"id": str(k), "created_utc": 1000 + k // same_second} for k in range(230)]

    def get(url):
        q = {k: int(v[0]) for k, v in parse_qs(urlparse(url).query).items() if k in ("after", "before", "limit")}
        return [x for x in items if q["after"] < x["created_utc"] < q["before"]][: q["limit"]], {}

    got = [x["id"] for x in paged.pages(get, "http://x", {}, 1000, 5000, FREE)]
    assert got == [x["id"] for x in items]


def test_slices_meet():
    r = paged.PagedReader({"after": "0", "before": "10", "slices": "3", "base": ""}, COMMENT)
    assert [(p.after, p.before) for p in r.partitions()] == [(0, 3), (3, 6), (6, 10)]


def test_state(spark, tmp_path):
    path = str(tmp_path / "s" / "state.json")
    assert state.load(path) == {"total_requests": 0, "total_batches": 0, "batches": []}
    sent = []

    def send(name):
        if len(sent) == 1:
            raise OSError("down")
        sent.append(name)
        return f"id-{name}"

    with pytest.raises(OSError):
        state.submit(path, ["b", "a"], send)
    assert [b["request_file"] for b in state.load(path)["batches"]] == ["a"]
    sent.clear()
    assert state.submit(path, ["b", "a"], lambda n: f"id-{n}") == ["b"]
    table = state.table(spark, state.load(path))
    assert state.pending(table).count() == 2 and state.downloadable(table).count() == 0 and not state.complete(state.load(path))
    fetched = []
    assert state.collect(path, lambda i: {"status": "ended"}, fetched.append, lambda s: None)
    assert len(fetched) == 2 and state.complete(state.load(path))
    assert not state.collect(str(tmp_path / "none.json"), None, None, lambda s: None, interval=1, most=2)


def test_stream_is_the_batch(spark, tmp_path):
    land = tmp_path / "in"
    land.mkdir()
    (land / "a.jsonl").write_text("\n".join([*lines(5), lines(1)[0], json.dumps({"id": "d", "body": "[deleted]", "created_utc": 1704067200}), "junk"]))
    rows = ingest.mentioning(ingest.comments(spark, str(land)), (Name("C", ("curry",)),))
    ingest.run_once(rows, str(tmp_path / "out"), str(tmp_path / "cp"))
    assert sorted(r["id"] for r in spark.read.parquet(str(tmp_path / "out")).collect()) == ["0", "1", "2", "3", "4"]
    (land / "b.jsonl").write_text("\n".join(lines(7)[5:]))
    again = ingest.mentioning(ingest.comments(spark, str(land)), (Name("C", ("curry",)),))
    ingest.run_once(again, str(tmp_path / "out"), str(tmp_path / "cp"))
    assert spark.read.parquet(str(tmp_path / "out")).count() == 7
