"""Request files that arrive in a folder go to a service of our own, each once."""

import json

import pytest

from tallyfold import state
from tallyfold.sources import batches
from tallyfold.streaming import service


class Fake:
    """Takes batches under keys; ``fails`` says when it breaks off: before it takes the next one, or after."""

    def __init__(self):
        self.taken, self.fails, self.fetched, self.asked = {}, None, [], 0

    def send(self, name, key):
        if self.fails == "before":
            raise OSError("before")
        assert key not in self.taken
        self.taken[key] = name
        if self.fails == "after":
            raise OSError("after")
        return f"id {batches.number_of(name)}"

    def find(self, key):
        self.asked += 1
        return f"id {batches.number_of(self.taken[key])}" if key in self.taken else None

    def poll(self, batch_id):
        return {"status": "ended"}

    def fetch(self, batch):
        self.fetched.append(batch["batch_num"])


@pytest.mark.parametrize("fails", ["before", "after"])
def test_each_file_is_sent_once(spark, tmp_path, fails):
    folder, path, checkpoint = tmp_path / "requests", str(tmp_path / "state.json"), str(tmp_path / "checkpoint")
    fake = Fake()
    run = lambda: service.run_once(spark, str(folder), fake, path, checkpoint)
    batches.write(spark.range(45), str(folder), "id", 10)
    run()
    assert [batches.number_of(n) for n in fake.taken.values()] == [1, 2, 3, 4, 5]

    (folder / "batch_012.jsonl").write_text('{"id": 1}\n\n{"id": 2}\n')
    (folder / "batch_006.jsonl").write_text('{"id": 3}\n')
    (folder / "notes.txt").write_text("none of ours")
    fake.fails = fails
    with pytest.raises(Exception, match=fails):
        run()
    assert len(fake.taken) == (6 if fails == "after" else 5)
    assert [b["status"] for b in state.load(path)["batches"]].count("sending") == 1 and not state.complete(state.load(path))
    fake.fails = None
    run()
    run()
    assert [batches.number_of(n) for n in fake.taken.values()] == [1, 2, 3, 4, 5, 6, 12] and fake.asked == 1
    found = json.loads(open(path).read())
    assert [(b["batch_num"], b["batch_id"], b["requests"]) for b in found["batches"]] == [(1, "id 1", 10), (2, "id 2", 10), (3, "id 3", 10), (4, "id 4", 10), (5, "id 5", 5), (6, "id 6", 1), (12, "id 12", 2)]
    assert found["total_requests"] == 48 and found["total_batches"] == 7
    assert service.collect(fake, path, lambda s: None) and fake.fetched == [1, 2, 3, 4, 5, 6, 12] and state.complete(state.load(path))
