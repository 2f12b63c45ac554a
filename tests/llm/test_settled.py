"""What a map task settles at once is bounded, however many rows a batch has; the repeats are the same."""

import pyarrow as pa

from txnguard.llm import repeats as R
from txnguard.llm.suffix_dedup import kept_bytes


def _texts():
    import random
    r = random.Random(5)
    word = lambda: "".join(r.choice("abcdefgh") for _ in range(7))
    shared = " ".join(word() for _ in range(40))
    return [(i, " ".join(word() for _ in range(60)) + " " + (shared if i % 3 else shared[50:]) + " " + word())
            for i in range(300)]


def test_parts_of_a_batch_give_the_same_rows(spark, monkeypatch):
    docs = spark.createDataFrame(_texts(), "doc_id long, text string").coalesce(1)
    whole = sorted(kept_bytes(docs, 100, digest=True).collect())
    monkeypatch.setattr(R, "SETTLED_AT_ONCE", 1)
    monkeypatch.setattr(R.rolling, "CHUNK_BYTES", 5_000)
    assert sorted(kept_bytes(docs, 100, digest=True).collect()) == whole
    assert sum(r.n_removed for r in whole) > 0


def test_a_batch_is_sent_on_in_parts(monkeypatch):
    """Runs the task's own function: before, all stretches of a batch were one record batch."""
    sent = {}

    class Docs:
        schema = {"doc_id": type("F", (), {"dataType": type("T", (), {"simpleString": staticmethod(lambda: "bigint")})})}

        def mapInArrow(self, run, schema):
            ids, texts = zip(*_texts(), strict=True)
            b = pa.RecordBatch.from_arrays([pa.array(ids), pa.array([0] * len(ids), pa.int16()), pa.array(texts)],
                                           ["doc_id", "tag", "text"])
            sent["rows"] = [x.num_rows for x in run([b])]

    monkeypatch.setattr(R, "SETTLED_AT_ONCE", 100)
    monkeypatch.setattr(R.rolling, "CHUNK_BYTES", 5_000)
    R.stretches(Docs(), R.byte_symbols, 100, 24, within=True, settled=False)
    assert len(sent["rows"]) > 5 and max(sent["rows"]) < 2_000
