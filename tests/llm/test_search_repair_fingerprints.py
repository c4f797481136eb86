"""Hard negatives, conversation repair and fingerprints against brute force, and on hard rows."""

from __future__ import annotations

import hashlib
import itertools
import math
import random
import re
import zlib

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from millrace.llm import conversations, fingerprints, hard_negatives

SMALL = "/root/testdata/sf0.001"


# --- conversations -------------------------------------------------------------------------------------------------

PATTERN, BEGINNING = re.compile(r"(s?(ua)+)?"), re.compile(r"s?(ua)*u?")


def cheapest(rows):
    """(cost, audit) over all edits, with up to two insertions in each gap."""
    best = [None]

    def go(i, audit, roles, cost):
        if best[0] is not None and cost > best[0][0]:
            return
        for count in range(3):
            for more in itertools.product("ua", repeat=count):
                out, price = roles + "".join(more), cost + 3 * count
                if not BEGINNING.fullmatch(out):
                    continue
                if i == len(rows):
                    if PATTERN.fullmatch(out) and (best[0] is None or (price, audit + "I" * count) < best[0]):
                        best[0] = (price, audit + "I" * count)
                    continue
                initial, fault = rows[i]
                go(i + 1, audit + "I" * count + "D", out, price + 4)
                if fault not in ("blank", "duplicate"):
                    price += 3 if fault == "truncated" else 0
                    for edit, role, more_cost in (("K", initial, 0), ("R", "u", 3), ("R", "a", 3)):
                        if BEGINNING.fullmatch(out + role):
                            go(i + 1, audit + "I" * count + edit, out + role, price + more_cost)

    go(0, "", "", 0)
    return best[0]


def test_repair_against_all_edits():
    draw, steps = random.Random(3), {}
    for _ in range(700):
        rows = [(draw.choice("suaaux"), draw.choice([None, None, None, "truncated", "blank", "duplicate"]))
                for _ in range(draw.randint(1, 6))]
        repair = conversations.Repair(steps)
        audit = "".join(e for row in rows for e in repair.add(*row)) + "".join(repair.finish())
        assert audit == cheapest(rows)[1], rows


def test_edits_are_emitted_early_and_forgotten():
    repair, waiting, most = conversations.Repair({}), 0, 0
    for i in range(20_000):
        waiting += 1 - len(list(repair.add("ua"[i % 2], "truncated" if i % 7 == 3 else None)))
        most = max(most, waiting)
    assert most <= 4


def test_survivors_without_roles_stay_unresolved_and_are_compared_whole():
    repair = conversations.Repair({})
    audit = "".join(e for _ in range(41) for e in repair.add("x", None)) + "".join(repair.finish())
    assert audit == "D" + "R" * 40  # as cheap as a deletion of any other row, and less in ASCII


def test_repaired_rows_and_digest(spark):
    text = "conv_id long, turn long, role string, text string, step string, fault string"
    rows = [(1, 0, "system", "Be kind."), (1, 1, "assistant", "Hi."), (1, 1, "assistant", "Hi."), (1, 3, "user", "cut off"), (1, 2, None, None),
            (2, None, "user", "No turn?"), (2, 5, "ugly", " \t"), (None, 1, "user", "x" * 100_000 + "."), (None, 2, "assistant", "Ok!")]
    frame = spark.createDataFrame([(*r, "a", "b") for r in rows], text)
    found = {r["conv_id"]: r for r in conversations.repair_report(frame).collect()}
    first = found[1]
    assert (first["gaps"], first["blank"], first["duplicate"], first["truncated"], first["illegal"]) == (0, 1, 1, 1, 4)
    edits = [tuple(r) for r in conversations.repaired_turns(frame).where("conv_id = 1").select("edit", "role", "text").collect()]
    kept = [(r, t) for e, r, t in edits if e != "D"]
    assert PATTERN.fullmatch("".join(r[0] for r, _ in kept)) and len(edits) == len(first["audit"])
    assert first["repaired_sha256"] == hashlib.sha256("\n".join(f"{r}:{t}" for r, t in kept).encode()).hexdigest()
    assert (found[2]["blank"], found[2]["gaps"], found[2]["audit"], found[2]["cost"]) == (1, 0, "KDI", 7)
    assert (found[None]["audit"], found[None]["cost"]) == ("KK", 0)
    assert conversations.repair_report(frame.limit(0)).count() == 0


def test_conversation_that_loses_all_rows(spark, tmp_path):
    lost = next(i for i in range(1000) if zlib.crc32(f"{i}:0".encode()) % 20 == 0)
    spark.createDataFrame([(lost, 0, "user", "Hm.")], "conv_id long, turn long, role string, text string").write.parquet(
        str(tmp_path / "conversations.parquet"))
    row = conversations.op12_conversation_repair(spark, str(tmp_path)).first().asDict()
    assert row.pop("repaired_sha256") == hashlib.sha256(b"").hexdigest() and row.pop("conv_id") == lost and row.pop("audit") == ""
    assert set(row.values()) == {0}


# --- hard negatives ------------------------------------------------------------------------------------------------

def by_brute_force(rows, is_anchor):
    found = []
    for a, label, x in rows:
        if not is_anchor(a):
            continue
        scored = sorted((-sum(p * q for p, q in zip(x, y)), b, other == label) for b, other, y in rows if b != a and len(y) == len(x))
        for minus, p, _ in [s for s in scored if s[2]][:5]:
            window = [(s, b) for s, b, same in scored if not same and 50 * -minus <= 100 * -s <= 95 * -minus]
            found += [(a, p, k + 1, b, -minus, -s) for k, (s, b) in enumerate(window[:3])]
    return sorted(found)


@pytest.mark.parametrize("size", [1, 400, 40_000_000])
def test_negatives_against_brute_force(size, spark, monkeypatch):
    """Small whole numbers give many ties; several shards and blocks; large ones need exact products."""
    monkeypatch.setattr(hard_negatives, "SHARD_VALUES", 600)
    monkeypatch.setattr(hard_negatives, "BLOCK_VALUES", 90)
    draw = np.random.default_rng(size)
    rows = [(i, i % 3, draw.integers(-2 * size, 3 * size, 6 if i % 40 else 5).tolist()) for i in range(400)]
    frame = spark.createDataFrame(rows + rows[:30], "vec_id long, label long, vector array<long>")
    got = hard_negatives.hard_negatives(frame, F.col("vec_id") % 10 == 0)
    want = by_brute_force(rows, lambda i: i % 10 == 0)
    assert sorted(tuple(r) for r in got.collect()) == want and want


def test_cells_come_in_descending_order():
    draw = np.random.default_rng(1)
    first, second = draw.normal(size=7), draw.integers(0, 3, 9).astype(float)
    walked = list(hard_negatives.descending_cells(first, second))
    assert [round(s, 9) for s, _, _ in walked] == sorted((round(a + b, 9) for a in first for b in second), reverse=True)
    assert len({(i, j) for _, i, j in walked}) == 63


def test_the_walk_stops_on_its_certificate():
    draw = np.random.default_rng(2)
    groups = draw.normal(size=(40, 16)) * 500
    vectors = np.rint(groups[np.arange(8000) % 40] + draw.normal(size=(8000, 16)) * 10).astype(np.int64)
    books = tuple(hard_negatives.codebook(h.astype(float), 32) for h in (vectors[:, :8], vectors[:, 8:]))
    index = hard_negatives.MultiIndex(np.arange(8000), np.arange(8000) % 5, vectors, books)
    seen = 0
    least = [-math.inf]
    for rows, scores in index.visited(vectors[0], least):
        seen += rows.stop - rows.start
        least[0] = max(least[0], float(np.sort(scores)[-5:].min()))
    assert seen < 1000
    best = index.best_of_label(vectors[0], 0, 0, 5)
    scores = vectors @ vectors[0]
    assert best == sorted(((int(scores[i]), i) for i in range(5, 8000, 5)), key=lambda r: (-r[0], r[1]))[:5]


def test_hard_rows_of_vectors(spark, tmp_path):
    rows = [(0, [1.0, 2.0], 1, "x"), (0, [1.0, 2.0], 1, "x"), (1, [1.0, 2.0], 1, "x"), (2, None, 1, "x"), (3, [float("nan"), 1.0], 2, "x"),
            (4, [0.5, 1.0], None, "x"), (5, [0.5, 1.5], 2, "x"), (6, [0.5, None], 2, "x"), (None, [1.0, 1.0], 2, "x"),
            (7, [], 2, "x"), (8, [1.0], 2, "x"), (9, [3e30, 1.0], 2, "x"), (10, [float("inf"), 1.0], 2, "x")]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int, rank string")
    frame.write.parquet(str(tmp_path / "some" / "embeddings.parquet"))
    got = [tuple(r) for r in hard_negatives.op11_hard_negatives(spark, str(tmp_path / "some")).collect()]
    # row 0 has the next label, 2, so its only positive is row 5; the window is [0.5, 0.95] of 229376
    assert got == []
    frame.limit(0).write.parquet(str(tmp_path / "none" / "embeddings.parquet"))
    assert hard_negatives.op11_hard_negatives(spark, str(tmp_path / "none")).count() == 0


# --- fingerprints --------------------------------------------------------------------------------------------------

def padded_shingles(text, words=5):
    found = [""] * (words - 1) + re.findall(r"[^\x20\x09-\x0D]+", "".join(c.lower() if c < "\x80" else c for c in text))
    return {tuple(found[i:i + words]) for i in range(len(found) - words + 1)}


def jaccard(a, b):
    a, b = padded_shingles(a), padded_shingles(b)
    return len(a & b) / len(a | b) if a | b else 1.0


def test_signatures_are_the_least_values(monkeypatch):
    monkeypatch.setattr(fingerprints, "BLOCK", 7)
    texts = ["", "one", " ".join(f"w{i % 30}" for i in range(40)), "  ", "a b c d e f", "A B\tc d e f"]
    hashes, bounds = fingerprints.shingles(pa.array(texts))
    assert [len(set(hashes[a:b].tolist())) for a, b in zip(bounds, bounds[1:])] == [len(padded_shingles(t)) for t in texts]
    found = fingerprints.signatures(hashes, bounds)
    from millrace.llm.common import process_cache
    scale, shift = process_cache("fingerprint factors", None)
    for k in range(0, fingerprints.PERMUTATIONS, 11):
        for t, (a, b) in enumerate(zip(bounds, bounds[1:])):
            values = [(int(x) * int(scale[k]) + int(shift[k])) % 2 ** 64 for x in hashes[a:b]]
            assert int(found[t, k]) == min(values, default=2 ** 64 - 1)
    assert (found[4] == found[5]).all()


def test_edited_texts_and_likeness(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "text").toPandas().sort_values("doc_id")
    texts = docs["text"].fillna("").tolist()
    after = texts[1:] + texts[:1]
    edited = [a[:len(a) - len(a) // 2] + b[:len(a) // 2] for a, b in zip(texts, after)]
    found = fingerprints.op13_document_fingerprints(spark, SMALL).toPandas().sort_values("doc_id")
    assert found["doc_id"].tolist() == docs["doc_id"].tolist()
    assert found["n_chars"].tolist() == [len(t) for t in texts]
    assert found["edited_sha256"].tolist() == [hashlib.sha256(t.encode()).hexdigest() for t in edited]
    for a, b, got in ((texts, edited, found["near_edited"]), (texts, after, found["near_next"])):
        error = np.abs(np.array([jaccard(x, y) for x, y in zip(a, b)]) - got.to_numpy())
        assert error.max() < 0.2 and error.mean() < 0.04
    same = {}
    assert all(same.setdefault(t, f) == f for t, f in zip(texts, found["fingerprint"]))


def test_fingerprints_of_hard_rows(spark):
    long = " ".join(f"word{i % 997}x{i % 89}" for i in range(60_000))
    rows = [(5, "b c d e f g", "x"), (5, "a b", "x"), (2, "0123456789", "x"), (None, "no id", "x"), (None, None, "x"), (9, None, "x"), (7, long, "x"), (8, "", "x")]
    frame = spark.createDataFrame(rows, "doc_id long, text string, range string")
    found = {(r["doc_id"], r["n_chars"]): r for r in fingerprints.edited_fingerprints(frame).collect()}
    assert len(found) == len(rows)

    def sha(text):
        return hashlib.sha256(text.encode()).hexdigest()

    assert found[2, 10]["edited_sha256"] == sha("01234a b")  # of the two rows 5 the lesser text follows
    assert found[5, 3]["edited_sha256"] == sha("a " + long[:1]) and found[5, 11]["edited_sha256"] == sha("b c d " + long[:5])
    assert found[9, 0]["near_edited"] == 1.0 and found[8, 0]["near_next"] == 1.0 and found[9, 0]["near_next"] == 0.0
    assert found[None, 5]["edited_sha256"] == sha("no ") and found[None, 5]["near_next"] == 0.0
    assert found[7, len(long)]["edited_sha256"] == sha(long[:len(long) - len(long) // 2])
    assert fingerprints.edited_fingerprints(frame.limit(0)).count() == 0
    one = fingerprints.edited_fingerprints(frame.where("doc_id = 2")).first()  # a single document follows itself
    assert one["edited_sha256"] == sha("0123401234") and one["near_next"] == 1.0


def test_many_ranges_meet_at_their_borders(spark):
    rows = [(i * i * 3 - 50, f"document {i} has its own words {i * 7} and {i * 11}") for i in range(300)]
    spark.conf.set("spark.sql.shuffle.partitions", "23")
    try:
        found = {r["doc_id"]: r["edited_sha256"] for r in fingerprints.edited_fingerprints(
            spark.createDataFrame(rows[::-1], "doc_id long, text string").repartition(5)).collect()}
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "8")
    for (i, text), (_, later) in zip(rows, rows[1:] + rows[:1]):
        half = len(text) // 2
        assert found[i] == hashlib.sha256((text[:len(text) - half] + later[:half]).encode()).hexdigest()


def test_near_documents_by_bands(spark):
    draw = random.Random(8)
    texts = [" ".join(draw.choices("abcdefghijklmnop", k=80)) for _ in range(30)]
    texts += [" ".join(w if k != 40 else "new" for k, w in enumerate(t.split())) for t in texts[:12]]  # near copies
    texts += [texts[20], "", None]
    frame = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r["doc_id"]: r["component_id"] for r in fingerprints.near_by_fingerprint(frame).collect()}
    sets = [padded_shingles(t or "") for t in texts]
    label = list(range(len(texts)))
    for _ in texts:
        for a, b in itertools.combinations(range(len(texts)), 2):
            if sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b]):
                label[a] = label[b] = min(label[a], label[b])
    assert got == dict(enumerate(label))
