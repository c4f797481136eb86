"""Token ids of whole texts, from a tokenizer file whose words never reach over ASCII white space."""

from __future__ import annotations

import json
from collections.abc import Iterable, Iterator
from itertools import islice

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from millrace.llm.common import process_cache, word_codes

# ASCII signs that the tokenizer separates from a letter or digit before them (so not the apostrophe)
SIGNS = '!"#$%&()*+,-./:;<=>?@[\\]^_`{|}~'
CACHE_BYTES = 48 << 20  # about what one worker's memory of words may take
LETTER = np.zeros(256, bool)  # bytes that are an ASCII letter or digit
LETTER[[*range(48, 58), *range(65, 91), *range(97, 123)]] = True
TOGETHER = 1024  # words given to the tokenizer as one text
ENTRY_BYTES = 240  # of a remembered word besides its characters and ids


def tokenizer_path(path: str | None) -> str:
    if path is None:
        import public_tokenizers
        path = public_tokenizers.path("word_bpe_49k.json")
    return path


def _strings(array: pa.Array) -> list[str]:
    return array.to_numpy(zero_copy_only=False).tolist()


class Words:
    """Ids of words as bytes, in two generations: when the young one is full, the old one is forgotten, and what is
    used again becomes young again. So memory is bounded by bytes and common words stay."""

    def __init__(self, most: int):
        self.most, self.size = most // 2, 0
        self.young: dict[str, bytes] = {}
        self.old: dict[str, bytes] = {}

    def find(self, words: list[str]) -> list[bytes | None]:
        """Their ids, None for each that is not remembered."""
        found = list(map(self.young.get, words))
        if self.old:
            for i in [i for i, ids in enumerate(found) if ids is None]:
                ids = found[i] = self.old.pop(words[i], None)
                if ids is not None:
                    self.put(words[i], ids)
        return found

    def put(self, word: str, ids: bytes) -> None:
        self.size += ENTRY_BYTES + 4 * len(word) + len(ids)
        if self.size > self.most:
            self.old, self.young, self.size = self.young, {}, ENTRY_BYTES + 4 * len(word) + len(ids)
        self.young[word] = ids


class Encoder:
    """Encodes each distinct word of a batch once and remembers words within a bound."""

    def __init__(self, path: str, plain: bool):
        import os
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer
        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = plain  # their strings are then ordinary text
        vocabulary = self.tokenizer.get_vocab()
        suffix = json.loads(self.tokenizer.to_str())["model"].get("end_of_word_suffix")
        self.ends = np.zeros(max(vocabulary.values()) + 1, bool)
        if suffix:
            self.ends[[i for t, i in vocabulary.items() if t.endswith(suffix)]] = True
        self.words = Words(CACHE_BYTES)

    def encoded(self, texts: Iterable[str], together: int) -> Iterator[np.ndarray]:
        """Ids of each text, read some at a time."""
        texts = iter(texts)
        while some := list(islice(texts, together)):
            for found in self.tokenizer.encode_batch_fast(some, add_special_tokens=False):
                yield np.array(found.ids, dtype="<u4")

    def learned(self, words: list[str]) -> list[bytes]:
        """The ids of different words; the tokenizer reads those that are not remembered."""
        found = self.words.find(words)
        new = [i for i, ids in enumerate(found) if ids is None]
        simple = [i for i in new if words[i].isalpha()]
        rest = [i for i in new if not words[i].isalpha()]
        groups = [simple[at:at + TOGETHER] for at in range(0, len(simple), TOGETHER)]
        joined = self.encoded((" ".join([words[i] for i in group]) for group in groups), 8)
        for group, ids in zip(groups, joined):  # a word of letters ends at its only word-end token
            cuts = np.flatnonzero(self.ends[ids]) + 1
            if len(cuts) != len(group) or cuts[-1] != len(ids):
                rest += group
                continue
            start, flat = 0, ids.tobytes()
            for i, end in zip(group, (4 * cuts).tolist()):
                found[i] = flat[start:end]
                start = end
        for i, ids in zip(rest, self.encoded((words[i] for i in rest), 1024)):
            found[i] = ids.tobytes()
        for i in new:
            self.words.put(words[i], found[i])
        return found

    def ends_in_letter(self, word: str) -> bool:
        """Whether the tokenizer sees a letter or digit last; it may write one as a letter and a mark."""
        normalizer = self.tokenizer.normalizer
        seen = normalizer.normalize_str(word) if normalizer and not word[-1].isascii() else word
        return bool(seen) and seen[-1].isalnum()

    def parted(self, distinct: pa.Array, special: bool) -> tuple[pa.Array, np.ndarray, list[str]]:
        """Words without the signs at their end, and which words had which signs: those that the tokenizer separates."""
        cores = pc.utf8_rtrim(distinct, characters=SIGNS)
        size, whole = (np.asarray(pc.binary_length(a), dtype=np.int64) for a in (cores, distinct))
        cut = (size > 0) & (size < whole)
        if special:
            cut &= ~np.asarray(pc.match_substring(distinct, "<|"))
        _, offsets, data = cores.buffers()  # of a new array, so without an offset of its own
        ends = np.frombuffer(offsets, np.int32)[1:len(cores) + 1]
        letters = np.frombuffer(data, np.uint8) if data and len(data) else np.zeros(1, np.uint8)
        last = letters[np.maximum(ends - 1, 0)]
        plain = LETTER[last]
        for i in np.flatnonzero(cut & ~plain).tolist():
            cut[i] = last[i] >= 128 and self.ends_in_letter(cores[i].as_py())
        at = np.flatnonzero(cut)
        lengths = np.asarray(pc.utf8_length(cores.take(pa.array(at))), dtype=np.int64)
        signs = [w[n:] for w, n in zip(_strings(distinct.take(pa.array(at))), lengths.tolist())]
        return pc.if_else(pa.array(cut), cores, distinct), at, signs

    def ids(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts in a row and their bounds, one entry more than texts."""
        special = pc.any(pc.match_substring(texts, "<|")).as_py()
        distinct, codes, bounds = word_codes(texts, lower=not special)
        heads, at, signs = self.parted(distinct, bool(special))
        heads = heads.dictionary_encode()
        names = dict.fromkeys(_strings(heads.dictionary))
        names.update(dict.fromkeys(signs))
        place = {name: i for i, name in enumerate(names)}
        known = self.learned(list(names))
        lists = list(map(known.__getitem__, np.asarray(heads.indices).tolist()))
        for i, sign in zip(at.tolist(), signs):
            lists[i] += known[place[sign]]
        sizes = np.fromiter(map(len, lists), np.int64, len(lists)) // 4
        flat = np.frombuffer(b"".join(lists), dtype="<u4").astype(np.int64)
        each = sizes[codes]
        ends = np.cumsum(each)
        total = int(ends[-1]) if len(ends) else 0
        where = np.arange(total) + np.repeat((np.cumsum(sizes) - sizes)[codes] - (ends - each), each)
        return flat[where], np.r_[0, ends][bounds]


def encoder(path: str, plain: bool = False) -> Encoder:
    return process_cache(f"encoder {path} {plain}", lambda: Encoder(path, plain))
