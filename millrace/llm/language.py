"""Language spans of mixed text: script ranges, word scores and Viterbi with a switching penalty.

Learning counts, for each language, hashed character n-grams of words and the scripts of their letters, over
all training texts. A word's script narrows the languages that it may belong to: only those that write it are
scored by its n-grams, and where one language alone writes it nothing is scored at all. Text without spaces is cut where its
script changes. The best path through the words, where a switch costs ``SWITCH``, labels spans. A text whose
best path can't switch is not searched: no run of words scores a switch more in any language than in the best one, nor
do the best run at the start and the best run at the end together.

A document gets the language of most of its letters, and their share as the score. Text that is null or has no
letter is ``und`` with score 0, and so is all text where nothing could be learned. Ties go to the language
first in the alphabet. Rows that repeat a ``doc_id`` are labelled each. Other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.llm.common import slices, stored, table, word_codes

BUCKETS, LENGTHS = 1 << 16, (2, 3)
SWITCH, UNLIKELY, SMOOTHING = 12.0, 8.0, 0.5  # log units: a change of language, each of a word's first letters in another script
TELLING = 4  # letters of a word that tell its script
LANGUAGES = 200  # most languages that can be learned
# First code points of blocks, with the script of each; blocks not named are "other". Fixed values.
RANGES = [(0x0000, "latin"), (0x0370, "greek"), (0x0400, "cyrillic"), (0x0530, "armenian"), (0x0590, "hebrew"),
          (0x0600, "arabic"), (0x0700, "other"), (0x0750, "arabic"), (0x0780, "other"), (0x0900, "devanagari"),
          (0x0980, "bengali"), (0x0A00, "other"), (0x0B80, "tamil"), (0x0C00, "other"), (0x0E00, "thai"),
          (0x0E80, "other"), (0x10A0, "georgian"), (0x1100, "hangul"), (0x1200, "other"), (0x1E00, "latin"),
          (0x1F00, "greek"), (0x2000, "other"), (0x2C60, "latin"), (0x2C80, "other"), (0x3040, "kana"),
          (0x3100, "other"), (0x3400, "han"), (0xA000, "other"), (0xA720, "latin"), (0xA800, "other"),
          (0xAC00, "hangul"), (0xD7B0, "other"), (0xF900, "han"), (0xFB00, "other"), (0x20000, "han"), (0x32000, "other")]
SCRIPTS = sorted({s for _, s in RANGES})
_FIRST = np.array([r[0] for r in RANGES])
_SCRIPT = np.array([SCRIPTS.index(r[1]) for r in RANGES])


def word_parts(words: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Of words: hashed n-grams in a row, n-grams of each, letters of each, script of its first letter (or -1)."""
    kept = ["".join(c for c in w.lower() if c.isalpha()) if not w.isalpha() else w.lower() for w in words]
    letters = np.array([len(w) for w in kept], dtype=np.int64)
    script = np.full(len(words), -1)
    has = np.flatnonzero(letters)
    first = np.array([ord(kept[i][0]) for i in has.tolist()], dtype=np.int64)
    script[has] = _SCRIPT[np.searchsorted(_FIRST, first, side="right") - 1]
    points = np.frombuffer("".join(f"\x02{w}\x03" if w else "" for w in kept).encode("utf-32-le", "replace"), np.uint32).astype(np.uint64)
    size = np.where(letters > 0, letters + 2, 0)
    ends = np.cumsum(size)
    left = np.repeat(ends, size) - np.arange(len(points))
    owner = np.repeat(np.arange(len(words)), size)
    grams, owners = [], []
    for n in LENGTHS:
        total = np.full(max(len(points) - n + 1, 0), n, np.uint64)
        for k in range(n):
            total = (total + points[k:len(points) - n + 1 + k]) * np.uint64(0xC2B2AE3D27D4EB4F)
            total ^= total >> np.uint64(31)
        keep = left[:len(total)] >= n
        grams.append((total[keep] >> np.uint64(44)).astype(np.int64) % BUCKETS)
        owners.append(owner[:len(total)][keep])
    gram, own = np.concatenate(grams), np.concatenate(owners)
    order = np.argsort(own, kind="stable")
    return gram[order], np.bincount(own, minlength=len(words)), letters, script


def script_runs(word: str) -> list[str]:
    """The word cut where the script of its letters changes; what is no letter stays with the letters before it."""
    if max(word, default="") < "\u0370":  # all Latin
        return [word]
    cuts, now = [0], None
    for i, c in enumerate(word):
        if c.isalpha():
            script = _SCRIPT[np.searchsorted(_FIRST, ord(c), side="right") - 1]
            if now is not None and script != now:
                cuts.append(i)
            now = script
    return [word[a:b] for a, b in zip(cuts, [*cuts[1:], len(word)])]


def runs_of(distinct: list[str], codes: np.ndarray, bounds: np.ndarray) -> tuple[list[str], np.ndarray, np.ndarray, np.ndarray]:
    """Words cut into runs of one script: distinct runs, code of every run, bounds of the texts, word of every run."""
    cut = [script_runs(w) for w in distinct]
    if all(len(runs) == 1 for runs in cut):
        return distinct, codes, bounds, np.arange(len(codes))
    names: dict[str, int] = {}
    flat = np.array([names.setdefault(r, len(names)) for runs in cut for r in runs], dtype=np.int64)
    size = np.array([len(runs) for runs in cut], dtype=np.int64)
    each = size[codes]
    ends = np.cumsum(each)
    at = np.arange(int(ends[-1])) + np.repeat((np.cumsum(size) - size)[codes] - (ends - each), each)
    return list(names), flat[at], np.r_[0, ends][bounds], np.repeat(np.arange(len(codes)), each)


def word_scores(table_: np.ndarray, may: np.ndarray, gram: np.ndarray, each: np.ndarray, letters: np.ndarray, script: np.ndarray) -> np.ndarray:
    """Score of every word in every language. Only languages that write the word's script are scored by its n-grams;
    all others lie below the best of them by UNLIKELY for each of the letters that tell the script."""
    scores = np.zeros((len(each), len(table_)))
    owner = np.repeat(np.arange(len(each)), each)
    for s in np.unique(script[script >= 0]).tolist():
        words, here = np.flatnonzero(script == s), np.flatnonzero(may[s])
        if len(here) > 1:
            own = script[owner] == s
            place = np.zeros(len(each), np.int64)
            place[words] = np.arange(len(words))
            at, grams = place[owner[own]], gram[own]
            for k in here.tolist():
                scores[words, k] = np.bincount(at, table_[k][grams], len(words))
        rest = np.flatnonzero(~may[s])
        if len(rest):
            least = scores[np.ix_(words, here)].max(axis=1) - UNLIKELY * np.minimum(letters[words], TELLING)
            scores[np.ix_(words, rest)] = least[:, None]
    return scores


def _counter(languages: list[str]):
    place = {lang: i for i, lang in enumerate(languages)}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros((len(languages), BUCKETS + len(SCRIPTS)), np.int64)
        for batch in batches:
            for start, length in slices(batch.column(0)):
                part = batch.slice(start, length)
                distinct, codes, bounds = word_codes(part.column(0))
                distinct, codes, bounds, _ = runs_of(distinct.to_pylist(), codes, bounds)
                gram, each, letters, script = word_parts(distinct)
                owner = np.repeat(np.arange(len(each)), each)
                lang = np.repeat([place[x] for x in part.column(1).to_pylist()], np.diff(bounds))
                for k in set(lang.tolist()):
                    times = np.bincount(codes[lang == k], minlength=len(each))
                    counts[k, :BUCKETS] += np.bincount(gram, weights=times[owner], minlength=BUCKETS).astype(np.int64)
                    seen = script >= 0
                    counts[k, BUCKETS:] += np.bincount(script[seen], weights=(times * letters)[seen], minlength=len(SCRIPTS)).astype(np.int64)
        k, gram = np.nonzero(counts)
        yield pa.RecordBatch.from_arrays([pa.array(k, pa.int32()), pa.array(gram, pa.int32()), pa.array(counts[k, gram])],
                                         names=["lang", "gram", "n"])
    return run


def viterbi(scores: np.ndarray, switch: float) -> np.ndarray:
    """Best language of each word: rows are words, columns languages."""
    if not len(scores):
        return np.empty(0, dtype=np.int64)
    total = scores.sum(axis=0)
    best = int(total.argmax())
    gain = np.cumsum(scores - scores[:, [best]], axis=0)
    low = np.minimum.accumulate(np.vstack([np.zeros(scores.shape[1]), gain[:-1]]), axis=0)
    # m switches make m + 1 runs: one at the start, one at the end and m - 1 between, none worth more than a switch
    if (gain - low).max() <= switch and max(gain.max(), 0) + max((gain[-1] - low).max(), 0) <= switch:
        return np.full(len(scores), best)
    now, back, languages = scores[0].tolist(), [], range(scores.shape[1])
    for row in scores[1:].tolist():
        top = max(languages, key=now.__getitem__)
        floor = now[top] - switch
        step = []
        for k in languages:
            if now[k] >= floor:
                step.append(k)
                row[k] += now[k]
            else:
                step.append(top)
                row[k] += floor
        back.append(step)
        now = row
    path = [max(languages, key=now.__getitem__)]
    for step in reversed(back):
        path.append(step[path[-1]])
    return np.array(path[::-1])


def _labeller(languages: list[str], logs, allowed, spans: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table_, may = logs.value, allowed.value
        for batch in batches:
            for start, length in slices(batch.column(1), (32 << 20) // max(8, len(languages))):
                part = batch.slice(start, length)
                distinct, codes, bounds = word_codes(part.column(1), lower=not spans)
                distinct, codes, bounds, word = runs_of(distinct.to_pylist(), codes, bounds)
                gram, each, letters, script = word_parts(distinct)
                scores = word_scores(table_, may, gram, each, letters, script)
                found, shares, cut = [], [], []
                for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist()):
                    path = viterbi(scores[codes[a:b]], SWITCH)
                    weight = np.bincount(path, weights=letters[codes[a:b]], minlength=len(languages))
                    if weight.sum() > 0:
                        found.append(languages[int(weight.argmax())])
                        shares.append(float(weight.max() / weight.sum()))
                    else:
                        found.append("und")
                        shares.append(0.0)
                    if spans:
                        edges = np.flatnonzero(np.r_[True, path[1:] != path[:-1]]) if len(path) else np.empty(0, int)
                        first = word[a:b] - (word[a] if b > a else 0)  # a word with two scripts belongs to both spans
                        cut.append([{"first_word": int(first[x]), "words": int(first[y - 1] - first[x] + 1), "lang": languages[path[x]]}
                                    for x, y in zip(edges, np.r_[edges[1:], len(path)])])
                columns = [part.column(0), pa.array(found, pa.string()), pa.array(shares, pa.float64())]
                names = ["doc_id", "lang_pred", "score"]
                if spans:
                    columns.append(pa.array(cut, pa.list_(pa.struct([("first_word", pa.int32()), ("words", pa.int32()), ("lang", pa.string())]))))
                    names.append("spans")
                yield pa.RecordBatch.from_arrays(columns, names=names)
    return run


def labelled_languages(docs: DataFrame, train: str = "true", spans: bool = False) -> DataFrame:
    """One row per document: doc_id, held_out, lang_pred, score, and with ``spans`` the labelled runs of words.

    ``train`` is a condition on doc_id that says of which rows lang may be learned.
    """
    spark = docs.sparkSession
    known = docs.where(train).where("lang IS NOT NULL AND text IS NOT NULL").select("text", "lang")
    languages = sorted(r["lang"] for r in known.select("lang").distinct().limit(LANGUAGES + 1).collect())
    if len(languages) > LANGUAGES:
        raise ValueError(f"more than {LANGUAGES} languages")
    held_out = F.coalesce(~F.expr(train), F.lit(False)).alias("held_out")
    if not languages:
        out = docs.select("doc_id", held_out, F.lit("und").alias("lang_pred"), F.lit(0.0).alias("score"))
        return out.withColumn("spans", F.expr("cast(array() AS array<struct<first_word:int,words:int,lang:string>>)")) if spans else out
    counts = np.zeros((len(languages), BUCKETS + len(SCRIPTS)))
    summed = stored(known.mapInArrow(_counter(languages), "lang int, gram int, n long").groupBy("lang", "gram").agg(F.sum("n").alias("n")), "grams")
    found = summed.toPandas()  # at most a row for each language and hash
    counts[found["lang"], found["gram"]] = found["n"]
    grams, scripts = counts[:, :BUCKETS] + SMOOTHING, counts[:, BUCKETS:]
    logs = np.log(grams / grams.sum(axis=1, keepdims=True)).astype(np.float32)
    # a language writes the scripts that hold a hundredth of its letters; a script that none writes narrows nothing
    allowed = (scripts >= 0.01 * np.maximum(scripts.sum(axis=1, keepdims=True), 1)).T
    allowed[~allowed.any(axis=1)] = True
    context = spark.sparkContext
    schema = "doc_id long, lang_pred string, score double" + ", spans array<struct<first_word:int,words:int,lang:string>>" * spans
    labelled = docs.select("doc_id", "text").mapInArrow(_labeller(languages, context.broadcast(logs), context.broadcast(allowed), spans), schema)
    return labelled.select("doc_id", held_out, *labelled.columns[1:])


TRAIN = "crc32(cast(cast(doc_id AS string) AS binary)) % 4 != 2"


def op3_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return labelled_languages(table(spark, sf_dir, "documents"), TRAIN)
