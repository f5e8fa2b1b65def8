"""From raw lines to the document and the race, over small files."""

import csv
import json

import pytest
import zstandard

from tallyfold import programs, state
from tallyfold.sources import batches, config

ENTITIES = """
players:
  Ann Lee: {aliases: [ann, annie], team: Reds, conference: East, player_id: 1, headshot_url: ann.png}
  Bob Ray: {aliases: [bob], team: Blues, conference: West, player_id: 2}
  Cy Poe: {aliases: [cy]}
short_aliases: [cy]
"""
TEAMS = """
teams:
  Reds: {abbreviation: RED, conference: East, team_id: 7, aliases: [red stars], logo_url: red.png}
  Blues: {abbreviation: BLU, conference: West, team_id: 8, aliases: [the blues]}
"""
MONDAY = 1704067200
#: (id, body, flair, days after a Monday, reply); without a reply the comment isn't answered for
RAW = [
    ("a", "annie is good", "Red Stars fan", 0, '{"s": "pos", "c": 0.9, "p": null}'),
    ("b", "ann and bob", "BLU", 1, '{"s": "neg", "c": 0.8, "p": "bob"}'),
    ("c", "bob again", None, 8, '{"s": "neg", "c": 1, "p": null}'),
    ("d", "bob once more", "red stars", 9, "not an answer"),
    ("e", "fancy that", None, 3, None),
    ("f", "[deleted]", None, 3, None),
    ("g", "ann, bob", "x", 15, '{"s": "neu", "p": "nobody"}'),
    ("h", "cy!", "the blues", 15, None),
]


@pytest.fixture(scope="module")
def folder(tmp_path_factory):
    root = tmp_path_factory.mktemp("season")
    (root / "entities.yaml").write_text(ENTITIES)
    (root / "teams.yaml").write_text(TEAMS)
    rows = [{"id": i, "body": b, "author": "x", "author_flair_text": f, "subreddit": "Ball", "created_utc": MONDAY + 86400 * d, "score": 1, "junk": 0} for i, b, f, d, _ in RAW]
    lines = [json.dumps(r) for r in rows] + ["", "{broken", "[1]", json.dumps(rows[0] | {"id": "z", "subreddit": "other"})]
    (root / "raw.jsonl").write_text("\n".join(lines))
    (root / "raw.zst").write_bytes(zstandard.ZstdCompressor().compress("\n".join(lines).encode()))
    return root


def test_from_raw_lines_to_the_race(spark, folder):
    p = {n: str(folder / n) for n in ("clean", "clean_zst", "mentions", "batches", "facts", "dead", "views", "doc.json", "race.csv", "state.json")}
    names, teams = config.entities(str(folder / "entities.yaml")), config.teams(str(folder / "teams.yaml"))

    counts = programs.clean(spark, str(folder / "raw.jsonl"), p["clean"], ["ball"])
    assert counts == {"lines": 11, "malformed": 2, "total": 9, "accepted": 7, "rejected_source": 1, "rejected_body": 1}
    assert programs.clean(spark, str(folder / "raw.zst"), p["clean_zst"], ["ball"]) == counts

    counts = programs.mentions(spark, p["clean"], p["mentions"], names)
    assert counts == {"lines": 7, "malformed": 0, "total": 7, "accepted": 6, "rejected_mention": 1}

    assert programs.prepare(spark, p["mentions"], p["batches"], "some-model", 4) == {"batches": 2}
    files = {f.name: [json.loads(x) for x in f.read_text().splitlines()] for f in (folder / "batches").iterdir()}
    assert {k: [r["custom_id"] for r in v] for k, v in files.items()} == {"batch_001.jsonl": ["a", "b", "c", "d"], "batch_002.jsonl": ["g", "h"]}
    assert files["batch_002.jsonl"][1]["params"]["messages"][0]["content"].count("cy!") == 1

    replies = {i: r for i, _, _, _, r in RAW if r}
    ok = [{"custom_id": i, "result": {"type": "succeeded", "message": {"content": [{"text": r}], "usage": {"input_tokens": 10, "output_tokens": 2}}}} for i, r in replies.items()]
    ok.append(ok[0] | {"custom_id": "gone"})
    bad = [{"custom_id": "h", "result": {"type": "expired"}}]
    (folder / "results.jsonl").write_text("\n".join(json.dumps(r) for r in ok + bad))
    state.save(p["state.json"], {"batches": [{"status": "ended", "results_downloaded": False}]})
    arguments = (spark, str(folder / "results.jsonl"), p["mentions"], p["facts"], p["dead"], p["state.json"])
    assert programs.collect(*arguments) is None and not (folder / "facts").exists()
    state.save(p["state.json"], {"batches": [{"status": "ended", "results_downloaded": True}]})
    counts = programs.collect(*arguments)
    assert {k: counts[k] for k in ("labels", "rows", "input_tokens", "output_tokens")} == {"labels": 6, "rows": 5, "input_tokens": 60, "output_tokens": 12} and counts["cost"] > 0
    assert [r["custom_id"] for r in spark.read.json(p["dead"]).collect()] == ["h"]

    programs.aggregate(spark, p["facts"], p["views"], p["doc.json"], names, teams, "2024")
    doc = json.loads((folder / "doc.json").read_text())
    assert [(r["entity"], r["comment_count"], r["neg_count"], r["neg_rate"]) for r in doc["entity_overall"]] == [("Bob Ray", 2, 2, 1.0), ("Ann Lee", 1, 0, 0.0)]
    assert [(r["entity"], r["week"], r["comment_count"]) for r in doc["entity_temporal"]] == [("Ann Lee", "2024-01-01", 1), ("Bob Ray", "2024-01-01", 1), ("Bob Ray", "2024-01-08", 1)]
    assert [(r["entity"], r["team"]) for r in doc["entity_team"]] == [("Ann Lee", "Reds"), ("Bob Ray", "Blues")]
    assert {(r["team"], r["abbreviation"], r["conference"], r["logo"]) for r in doc["team_overall"]} == {("Reds", "RED", "East", "red.png"), ("Blues", "BLU", "West", None)}
    assert {(r["entity"], r["team"], r["logo"]) for r in doc["entity_metadata"]} == {("Ann Lee", "Reds", "red.png"), ("Bob Ray", "Blues", None)}
    meta = doc["metadata"]
    assert [meta[k] for k in ("total_comments", "usable_comments", "excluded_comments", "attributed_comments", "entity_count", "team_count", "week_count", "season")] == [5, 4, 1, 3, 2, 2, 3, "2024"]

    # the last week of the views, 2024-01-08, is left out as a stub
    assert programs.race(spark, p["views"], p["race.csv"], names, top=5, min_ranking=1, min_entry=1) == 2
    assert list(csv.reader((folder / "race.csv").open())) == [["Label", "Category", "Image", "2024-01-01"], ["Ann Lee", "Reds", "ann.png", "0.0"], ["Bob Ray", "Blues", "", "100.0"]]


def test_submit_all_goes_on_after_a_pause(tmp_path):
    path, sent, ready = str(tmp_path / "state.json"), [], set()

    def send(name):
        sent.append(name)
        return f"id-{name}"

    def poll(batch_id):
        return {"status": "ended"} if batch_id in ready else {}

    fetched = []
    run = lambda: programs.submit_all(path, ["r1", "r2", "r3"], send, poll, lambda b: fetched.append(b["request_file"]), lambda s: None, interval=1, most=0)
    assert not run() and sent == ["r1"]
    ready.update({"id-r1", "id-r2", "id-r3"})
    assert run() and sent == ["r1", "r2", "r3"] and fetched == sent


def test_arguments():
    a = programs._arguments().parse_args(["race", "--views", "v", "--target", "t", "--entities", "e", "--top", "3"])
    assert (a.top, a.min_ranking, a.min_entry) == (3, 5000, 1000)
    assert programs._arguments().parse_args(["clean", "--source", "s", "--target", "t", "--sources", "a", "b"]).sources == ["a", "b"]


def test_prepared_files_are_sent_in_the_order_of_their_numbers(spark, tmp_path):
    """Twelve batches, by way of the files that prepare writes; a send fails once."""
    rows = [{"id": f"c{k:03d}", "body": f"text {k}", "mentioned_entities": ["x"]} for k in range(116)]
    (tmp_path / "mentions.jsonl").write_text("\n".join(map(json.dumps, rows)))
    assert programs.prepare(spark, str(tmp_path / "mentions.jsonl"), str(tmp_path / "requests"), "some-model", 10) == {"batches": 12}
    files, path, sent, fetched = batches.files(str(tmp_path / "requests")), str(tmp_path / "state.json"), [], []
    assert [len(open(f).readlines()) for f in files] == [10] * 11 + [6]
    assert [json.loads(x)["custom_id"] for f in files for x in open(f)] == [r["id"] for r in rows]

    def send(name):
        if len(sent) == 5 and "failed" not in sent:
            sent.append("failed")
            raise OSError("no answer")
        sent.append(name)
        return f"id {batches.number_of(name)}"

    run = lambda: programs.submit_all(path, files[::-1], send, lambda i: {"status": "ended"}, lambda b: fetched.append(b["batch_num"]), lambda s: None, at_once=2)
    with pytest.raises(OSError):
        run()
    assert run()
    assert [x for x in sent if x != "failed"] == files and fetched == list(range(1, 13))
    assert [(b["batch_num"], b["batch_id"]) for b in state.load(path)["batches"]] == [(k, f"id {k}") for k in range(1, 13)]
