"""Every operator of the llm package against brute force, a round trip or held-out accuracy, and on hard rows."""

from __future__ import annotations

import collections
import html
import random
import re
import zlib

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from millrace.llm import (embeddings, exact_dedup, html_extraction, language, minhash, mixing, packing, quality,
                          separators, tokens, toxicity)
from millrace.llm.common import components
from millrace.session import scratch_path

SF, SMALL = "/root/testdata/sf0.01", "/root/testdata/sf0.001"
# names that operators use inside, to clash with
CLASHING = ("keep_id", "rank", "block", "rep", "score", "units", "position", "recipe", "_salt", "_bin", "y")
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, " + ", ".join(f"{c} string" for c in CLASHING)
LONG = " ".join(f"word{i % 997}x{i % 89}" for i in range(60_000))
TEXTS = [(1, None), (2, ""), (3, "a b c"), (3, "a b c"), (None, "x y z. q"), (None, None), (4, LONG), (5, LONG),
         (6, LONG + " tail"), (7, " \t\n"), (8, "A  b\tc"), (9, "1 2 3 !?"), (10, "Ünïcode Ω 漢字 😀 слово")]


@pytest.fixture(scope="module")
def hard(spark):
    rows = [(i, t, "en" if k % 2 else None, None if k % 3 else "s", None, *("x" for _ in CLASHING)) for k, (i, t) in enumerate(TEXTS)]
    return spark.createDataFrame(rows, SCHEMA)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="module")
def labels(spark):
    return spark.createDataFrame([(4, 1, 1), (5, None, None), (2, 0, 0), (3, 1, 0), (None, 1, 1), (99, 0, 1)],
                                 "doc_id long, quality int, toxic int")


OPERATORS = {
    "op1": lambda d, l: mixing.mixed_order(d), "op2": lambda d, l: exact_dedup.exact_duplicates(d),
    "op3": lambda d, l: language.labelled_languages(d, spans=True), "op4": toxicity.toxicity_scores,
    "op5": quality.quality_scores, "op6": lambda d, l: minhash.near_duplicates(d)}


@pytest.mark.parametrize("name", sorted(OPERATORS))
def test_hard_rows_and_empty_tables(name, spark, hard, empty, labels):
    found = OPERATORS[name](hard, labels).collect()
    assert collections.Counter(r["doc_id"] for r in found) == collections.Counter(i for i, _ in TEXTS)
    assert OPERATORS[name](empty, labels.limit(0)).count() == 0
    if "score" in found[0]:
        assert all(0 <= r["score"] <= 1 for r in found)


def test_exact_groups_of_hard_rows(hard):
    found = {r["doc_id"]: r for r in exact_dedup.exact_duplicates(hard).collect() if r["doc_id"]}
    assert (found[5]["keep_id"], found[5]["kept"], found[4]["group_size"]) == (4, False, 2)
    assert found[1]["group_size"] == 3 and not found[2]["kept"]  # the row without an id is empty too
    assert found[7]["group_size"] == 1 and found[8]["keep_id"] == 8


def test_exact_identifiers_are_verified(spark):
    texts = [" ".join(random.Random(i // 3).choices(["alpha", "beta", "gamma."], k=900)) + " " * (i % 3) for i in range(60)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    found = exact_dedup.exact_duplicates(docs, chunk_id=lambda c: F.crc32(c) % 3).collect()
    first = {}
    for i, t in enumerate(texts):
        first.setdefault(re.sub(r"[ \t-\r]+", " ", t), i)
    assert {r["doc_id"]: r["keep_id"] for r in found} == {i: first[re.sub(r"[ \t-\r]+", " ", t)] for i, t in enumerate(texts)}


def test_exact_against_sql(spark):
    got = exact_dedup.op2_exact_dedup(spark, SF).toPandas().sort_values("doc_id").reset_index(drop=True)
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS FROM '{SF}/documents.parquet'")
    want = con.execute(exact_dedup.OP2_SQL).df().sort_values("doc_id").reset_index(drop=True)
    assert got[sorted(got.columns)].equals(want[sorted(want.columns)])


def linked_by_brute_force(rows, words, percent):
    sets, root = {}, {}
    for i, t in rows:
        w = re.sub("[A-Z]", lambda m: m[0].lower(), t or "")
        w = re.findall(r"[^\x20\x09-\x0D]+", w)
        sets[i] = {tuple(w)} if 0 < len(w) < words else {tuple(w[k:k + words]) for k in range(len(w) - words + 1)}
        root[i] = i

    def top(x):
        while root[x] != x:
            x = root[x]
        return x

    holders = collections.defaultdict(list)
    for i in sets:
        for s in sets[i]:
            holders[s].append(i)
    common = collections.Counter((a, b) for h in holders.values() for k, a in enumerate(h) for b in h[k + 1:])
    for (a, b), n in common.items():
        if 100 * n >= percent * (len(sets[a]) + len(sets[b]) - n):
            x, y = sorted((top(a), top(b)))
            root[y] = x
    return {i: (len(sets[i]), top(i)) for i in sets}


def test_near_duplicates_against_brute_force(spark):
    rng = random.Random(3)
    base = [f"w{i}" for i in range(150)]
    rows = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{SMALL}/documents.parquet").collect()]
    for i in range(400):  # a large group whose members differ by more and more edits
        words = list(base)
        for _ in range(rng.randint(0, 9)):
            words[rng.randrange(150)] = f"e{rng.randint(0, 99)}"
        rows.append((10_000 + i, " ".join(words)))
    want = linked_by_brute_force(rows, 4, 80)
    found = minhash.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"), 4, 80).collect()
    assert {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in found} == want
    assert len({c for _, c in want.values() if c >= 10_000}) > 3  # some members are linked with none


def test_blocks_give_the_same_links(spark, monkeypatch):
    import pandas as pd
    rng = np.random.default_rng(1)
    sets = [np.sort(rng.choice(60, rng.integers(5, 40), replace=False)) for _ in range(40)]
    frame = pd.DataFrame({"rep": range(40), "component": range(40), "shingles": sets})
    monkeypatch.setattr(minhash, "COLUMNS", 7)
    links = minhash._spanning_links(frame, frame, 30)
    similar = lambda a, b: 100 * len(set(a) & set(b)) >= 30 * len(set(a) | set(b))
    assert links and all(similar(sets[a], sets[b]) for a, b in links)
    reach = {i: i for i in range(40)}
    for _ in range(40):
        for a in range(40):
            for b in range(40):
                if similar(sets[a], sets[b]):
                    reach[a] = reach[b] = min(reach[a], reach[b])
    assert len(links) == 40 - len(set(reach.values()))


def test_components_of_a_long_chain_and_a_hub(spark):
    edges = [(i, i + 1) for i in range(100, 160)] + [(7, 200 + i) for i in range(300)]
    found = {r["node"]: r["component"] for r in components(spark.createDataFrame(edges, "a long, b long"), "a", "b", "t").collect()}
    assert {found[i] for i in range(100, 161)} == {100} and {found[200 + i] for i in range(300)} == {7}
    assert components(spark.createDataFrame([], "a long, b long"), "a", "b", "t").count() == 0


def test_language_of_held_out_documents(spark):
    found = language.op3_language_id(spark, SF).join(spark.read.parquet(f"{SF}/documents.parquet"), "doc_id").where("held_out").toPandas()
    assert (found["lang"] == found["lang_pred"]).mean() >= 0.97


def test_language_spans_of_mixed_text(spark):
    rows = [(i, t, lang) for i in range(8) for t, lang in (("the cat and the dog with this thing " * 5, "en"), ("der hund und die katze nicht auch " * 5, "de"))]
    rows += [(100, "the cat and the dog " * 3 + "der hund und die katze " * 3, None), (101, "12 !", None), (102, None, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    found = {r["doc_id"]: r for r in language.labelled_languages(docs, "doc_id < 50", spans=True).where("doc_id >= 100").collect()}
    assert [(s["first_word"], s["words"], s["lang"]) for s in found[100]["spans"]] == [(0, 15, "en"), (15, 15, "de")]
    assert found[101]["lang_pred"] == found[102]["lang_pred"] == "und"


def test_viterbi_against_all_paths():
    import itertools
    rng = np.random.default_rng(0)
    for _ in range(60):
        scores = rng.normal(0, 3, (6, 3))
        value = lambda p: sum(scores[k, x] for k, x in enumerate(p)) - 4 * sum(a != b for a, b in zip(p, p[1:]))
        best = max(itertools.product(range(3), repeat=6), key=value)
        assert value(language.viterbi(scores.copy(), 4.0)) == pytest.approx(value(best))


@pytest.mark.parametrize("query, column", [(toxicity.op4_toxicity, "toxic"), (quality.op5_quality_classifier, "quality")])
def test_classifiers_on_held_out_rows(spark, query, column):
    sf = "/root/testdata/sf0.1"
    found = query(spark, sf).join(spark.read.parquet(f"{sf}/labels.parquet"), "doc_id").where("held_out").toPandas()
    assert (found["predicted"] == found[column]).mean() >= 0.97
    assert found[found[column] == 1]["score"].median() > found[found[column] == 0]["score"].median()


def test_tokens_word_by_word_equal_whole_texts(spark):
    import pyarrow as pa
    from tokenizers import Tokenizer
    path = tokens.tokenizer_path(None)
    plain = Tokenizer.from_file(path)
    texts = [r["text"] for r in spark.read.parquet(f"{SMALL}/documents.parquet").limit(60).collect()] + [
        "", " x", "it's don't!! (a,b)...c|d", "<|endoftext|> A<|ENDOFTEXT|>b", "ΣΑΣ éa b c 3.5% 漢字!? 😀.", "İ ﬁ Ǆ"]
    ids, bounds = tokens.Encoder(path, False).ids(pa.array(texts))
    for k, t in enumerate(texts):
        assert ids[bounds[k]:bounds[k + 1]].tolist() == plain.encode(t, add_special_tokens=False).ids


def test_packing_round_trip(spark, hard, empty):
    from tokenizers import Tokenizer
    plain = Tokenizer.from_file(tokens.tokenizer_path(None))
    docs = spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "text")
    found = packing.packed(docs).toPandas()
    for r in docs.collect():
        ids = np.array(plain.encode(r["text"], add_special_tokens=False).ids + [2], dtype="<u4")
        at = 0
        for p in found[found.doc_id == r["doc_id"]].sort_values("start").itertuples():
            assert p.start == at and p.doc_tokens == len(ids)
            assert p.ids_crc32 == zlib.crc32(ids[at:at + p.length].tobytes())
            at += p.length
        assert at == len(ids)
    for _, s in found.groupby("sequence_id"):
        s = s.sort_values("offset")
        assert (s.offset == s.length.cumsum() - s.length).all() and s.length.sum() <= 4096
    assert found.length.sum() / (4096 * found.sequence_id.nunique()) > 0.95
    assert packing.packed(hard).select("doc_id").distinct().count() == len({i for i, _ in TEXTS})
    assert packing.packed(empty).count() == 0


def least_bins(counts, room):
    """No packing has fewer bins: items over half need a bin each, and small ones fit only beside the middle ones."""
    best = 0
    for small in range(room // 2 + 1):
        big = sum(n for s, n in counts.items() if s > room - small)
        middle = [(s, n) for s, n in counts.items() if room / 2 < s <= room - small]
        rest = sum(s * n for s, n in counts.items() if small <= s <= room / 2)
        beside = sum((room - s) * n for s, n in middle)
        best = max(best, big + sum(n for _, n in middle) + max(0, -(-(rest - beside) // room)))
    return best


def test_cutting_plan_is_whole_and_close_to_its_bound():
    rng = np.random.default_rng(2)
    for room in (16, 64):
        counts = {s: int(n) for s, n in zip(range(1, room + 1), rng.integers(0, 400, room))}
        plan = packing.cutting_plan(counts, room)
        used = collections.Counter()
        for pattern, copies in plan:
            assert sum(s * a for s, a in pattern.items()) <= room
            for s, a in pattern.items():
                used[s] += a * copies
        assert used == +collections.Counter(counts)
        assert sum(c for _, c in plan) <= least_bins(counts, room) + room


@pytest.mark.parametrize("block", [4, 64, 1 << 20])
def test_separator_scan_against_the_encoder(spark, hard, block):
    import pyarrow as pa
    target = scratch_path(spark, "flat")
    docs = spark.read.parquet(f"{SMALL}/documents.parquet").select("text").limit(40).unionByName(
        hard.select(F.substring("text", 1, 500).alias("text")))
    separators.write_flat(docs.coalesce(1), target)
    texts = [r["text"] for r in docs.coalesce(1).collect()]
    _, bounds = tokens.Encoder(tokens.tokenizer_path(None), True).ids(pa.array(texts, pa.string()))
    found = separators.token_counts(spark, target, block_bytes=block).orderBy("doc_no").collect()
    assert [r["n_tokens"] for r in found] == np.diff(bounds).tolist()
    assert [r["start"] for r in found] == (bounds[:-1] + np.arange(len(texts))).tolist()


def test_tokens_after_the_last_separator(spark, tmp_path):
    (tmp_path / "part-0").write_bytes(np.array([5, 6, 49407, 49407, 7], "<u2").tobytes())
    found = separators.token_counts(spark, str(tmp_path), block_bytes=4).orderBy("doc_no").collect()
    assert [(r["doc_no"], r["start"], r["n_tokens"]) for r in found] == [(0, 0, 2), (1, 3, 0), (2, 4, 1)]


def test_near_vectors_against_brute_force(spark, monkeypatch):
    monkeypatch.setattr(embeddings, "CELL", 24)
    monkeypatch.setattr(embeddings, "BLOCK", 16)
    rng = np.random.default_rng(4)
    centre = rng.normal(size=(12, 16))
    rows = [(i, (centre[i % 12] + rng.normal(0, 0.25, 16)).tolist()) for i in range(300)]
    rows += [(300 + i, rows[i % 5][1]) for i in range(40)] + [(400, [1e200 * x for x in rows[0][1]])]
    odd = [(500, None), (501, [0.0] * 16), (502, [float("nan")] + [1.0] * 15), (503, [None] + [1.0] * 15), (504, []),
           (505, [float("inf")] + [1.0] * 15), (506, [1.0, 2.0])]
    found = embeddings.near_vectors(spark.createDataFrame([(i, v, "x") for i, v in rows + odd], "vec_id long, embedding array<double>, rep string"))
    got = {r["vec_id"]: (r["n_links"], r["component_id"], r["kept"]) for r in found.collect()}
    unit = np.array([np.array(v) / np.abs(v).max() for _, v in rows])
    unit /= np.linalg.norm(unit, axis=1)[:, None]
    linked = unit @ unit.T >= 0.95
    low = np.array([i for i, _ in rows])
    for _ in range(len(rows)):
        low = np.where(linked, low[None, :], 10 ** 9).min(axis=1)
    assert {i: v for i, v in got.items() if i < 500} == {
        i: (int(linked[k].sum()) - 1, int(low[k]), i == low[k]) for k, (i, _) in enumerate(rows)}
    assert all(got[i] == (0, i, True) for i, _ in odd)
    assert embeddings.near_vectors(spark.createDataFrame([], "vec_id long, embedding array<float>")).count() == 0


def test_main_text_of_the_given_pages(spark):
    pages = spark.read.parquet(f"{SF}/pages.parquet").toPandas()
    found = html_extraction.op10_html_extraction(spark, SF).toPandas().set_index("page_id")
    for page in pages.itertuples():
        article = re.search("<article>(.*?)</article>", page.html, re.S)[1]
        blocks = (" ".join(html.unescape(re.sub("</?b>|<br>", " ", b)).split()) for b in re.split("</?(?:p|h1)>", article))
        assert found.text[page.page_id] == "\n".join(b for b in blocks if b)
        assert found.n_chars[page.page_id] == len(found.text[page.page_id])


def test_pages_with_everything_around_the_text(spark):
    body = "<p>A first sentence, with <i>some</i> words &amp; signs.<p>A second one; it is\n\n long enough to count.</p>"
    page = ("<html><body class='has-sidebar'><header><h1>Site</h1></header><div id=cookie-notice>We use cookies.</div>"
            f"<div class=content><h2>Title</h2>{body}<form>Name <input></form><!-- <p>no</p> --></div>"
            "<script>if (a<b) '<p>no</p>'</script><section class='comments'><p>Nice text, thank you all.</p></section>"
            "<aside>More</aside><footer>&copy; me</footer>")
    want = "Title\nA first sentence, with some words & signs.\nA second one; it is long enough to count."
    assert html_extraction.main_text(page) == want
    assert html_extraction.main_text("<p " + "<" * 50_000) is not None and html_extraction.main_text("<div>" * 5_000 + "x") == "x"
    frame = spark.createDataFrame([(1, None, page), (1, None, page), (None, "u", None), (2, "u", "")], "page_id long, url string, html string")
    assert sorted(r["n_chars"] for r in html_extraction.extracted(frame).collect()) == [0, 0, len(want), len(want)]


def test_mixing_keeps_to_its_targets(spark, hard):
    rng = random.Random(1)
    for _ in range(100):
        parts = [rng.randint(1, 12) for _ in range(rng.randint(1, 8))]
        taken = [0] * len(parts)
        for slot, k in enumerate(mixing.period(parts)):
            taken[k] += 1
            assert all(abs(t - (slot + 1) * p / sum(parts)) < 1 for t, p in zip(taken, parts))
        blocks = [rng.randint(0, 40) for _ in parts]
        slots = [first + j // len(at) * size + at[j % len(at)] for _, _, n, first, size, at in mixing.phases(parts, blocks) for j in range(n)]
        assert sorted(slots) == list(range(sum(blocks)))
    found = mixing.op1_mixing(spark, SF).toPandas()
    assert found["position"].is_unique and found["doc_id"].is_unique and len(found) == spark.read.parquet(f"{SF}/documents.parquet").count()
    mixed = mixing.in_mixed_order(hard)
    assert mixed.columns == hard.columns and mixed.count() == len(TEXTS)


def test_pipeline_stage_by_stage(spark, hard, empty):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns, seen = docs.columns, []
    for name, stage in corpus_pipeline.STAGES:
        before, docs = docs, stage(spark, docs, SF).persist()
        kept, had = ({r["doc_id"] for r in d.select("doc_id").distinct().collect()} for d in (docs, before))
        assert kept <= had and (name == "pack" or docs.columns == columns)
        if name == "quality":
            labels = {r["doc_id"]: r["quality"] for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
            assert sum(i in kept for i in had if labels.get(i) == 1) >= 0.97 * sum(labels.get(i) == 1 for i in had)
            assert sum(i in kept for i in had if labels.get(i) == 0) <= 0.1 * sum(labels.get(i) == 0 for i in had)
        if name == "exact":
            first = {}
            for i, t in sorted((r["doc_id"], re.sub(r"[ \t-\r]+", " ", r["text"] or "")) for r in before.collect()):
                first.setdefault(t, i)
            assert kept == set(first.values())
        if name == "near":
            rows = [(r["doc_id"], r["text"]) for r in before.collect()]
            assert kept == {c for _, c in linked_by_brute_force(rows, 5, 80).values()}
        if name in ("mix", "pack"):
            assert kept == had
        seen.append(name)
    assert seen == ["quality", "exact", "near", "mix", "pack"]
    for frame in (hard, empty):
        docs = frame
        for name, stage in corpus_pipeline.STAGES:
            docs = stage(spark, docs, SF)
            assert name == "pack" or docs.columns == frame.columns
        assert (docs.count() > 0) == (frame is hard)


def test_packed_sequences_follow_the_mix(spark, monkeypatch):
    monkeypatch.setattr(packing, "SEGMENT", 512)
    text = {"hot": "word " * 40, "mid": "some words " * 300, "low": "a b c d e f g " * 9}
    rows = [(i, text[s], s) for i, s in enumerate(["hot"] * 2400 + ["mid"] * 400 + ["low"] * 200)]
    rows = [(i, t + "more " * random.Random(i).randint(0, 60), s) for i, t, s in rows]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    found = corpus_pipeline.pack(spark, docs, SF).toPandas()
    order = mixing.mixed_order(docs).toPandas().set_index("doc_id")
    assert sorted(found.doc_id) == list(range(3000)) and set(found.sequence_id) == set(range(found.sequence_id.max() + 1))
    assert (found.groupby("sequence_id").length.sum() <= 4096).all()
    found["position"] = found.doc_id.map(order.position)
    found = found.sort_values(["sequence_id", "offset"])
    found["source"] = found.doc_id.map(order.source)
    assert (found.position // 512).is_monotonic_increasing
    mixed = order.sort_values("position").source.tolist()
    for at in range(256, 3000, 256):  # as many of each source as in the mix, up to half a segment
        have, want = collections.Counter(found.source[:at]), collections.Counter(mixed[:at])
        assert all(abs(have[s] - want[s]) <= 64 for s in text), (at, have, want)


@pytest.mark.parametrize("tag", ["<svg class='icon'/>", "<math/>", "<object data=x>", "<iframe src=x>", "<noscript>", "<svg>"])
def test_embedded_tags_without_an_end_cut_nothing(tag):
    assert html_extraction.main_text(f"<body><p>Some text, before.</p>{tag}<p>And some, after.</p>") == "Some text, before.\nAnd some, after."
    closed = f"<body><p>One text, here.</p><svg/><p>Another, here.</p><svg><text>no</text></svg>{tag}<p>A third, here.</p>"
    assert html_extraction.main_text(closed) == "One text, here.\nAnother, here.\nA third, here."


@pytest.mark.parametrize("tag", ["article", "div"])
def test_short_blocks_of_the_content_are_kept(tag):
    long = "A sentence of some length, with marks; it goes on, and on. " * 9
    page = (f"<body><div><{tag}><h2>Why</h2><p>{long}</p><ul><li>one item</li><li>two</li></ul><table><caption>Sizes</caption><tr><td>a</td>"
            f"<td>5</td></tr></table><blockquote><p>So be it.</p></blockquote><div><h3>How</h3></div><p>{long}</p></{tag}></div><nav>Home</nav>")
    want = ["Why", long.strip(), "one item", "two", "Sizes", "a", "5", "So be it.", "How", long.strip()]
    assert html_extraction.main_text(page).split("\n") == want


@pytest.mark.parametrize("start, end", [
    ("<div class='layout has-sidebar'>", "</div>"), ("<div id='page-with-menu'><article>", "</article></div>"), ("<section id='related-work'>", "</section>"),
    ("<div class='social-policy'><main>", "</main></div>"), ("<form>", "</form>"), ("<form><div class=comments-open>", "</div></form>"),
    ("<aside><main>", "</main></aside>")])
def test_wrappers_with_words_of_noise_lose_nothing(start, end):
    long = "A sentence of some length, with marks; it goes on. " * 8
    noise = "<div class=sidebar>More of us</div><nav>Home</nav><form>Name <input></form><p>Well, <span class=ad>buy</span> yes.</p>"
    comments = "<section class=comments><article>" + "So nice, thank you. " * 30 + "</article></section>"
    found = html_extraction.main_text(f"<body>{start}<h2>Why</h2><p>{long}</p>{noise}{end}<footer>me</footer>")
    assert found == f"Why\n{long.strip()}\nWell, yes."
    assert html_extraction.main_text(f"<body><div><p>{long}</p></div>{comments}") == long.strip()


def test_viterbi_where_two_languages_beat_the_one_between():
    import itertools
    assert language.viterbi(np.array([[8.0, -20, 0], [-20, 8, 0]]), 12.0).tolist() == [0, 1]
    rng = np.random.default_rng(5)
    for _ in range(60):  # a language between two others, as Norwegian
        scores = np.column_stack([rng.normal(0, 4, (5, 2)), np.zeros(5)])
        value = lambda p: sum(scores[k, x] for k, x in enumerate(p)) - 6 * sum(a != b for a, b in zip(p, p[1:]))
        assert value(language.viterbi(scores.copy(), 6.0)) == pytest.approx(max(map(value, itertools.product(range(3), repeat=5))))
