"""Token ids of whole texts by the tokenizers library, word by word.

For tokenizers whose normaliser and pre-tokeniser never look across ASCII white space (word-level BPE that drops white
space), a text's ids are its words' ids one after the other. Arrow splits the texts of a block into words and numbers
the different ones; only those pass through Python, where a bounded memo knows most of them. The ids of the block are
then gathered with numpy. `exact_by_words` tells whether a tokenizer is of this kind; any other is run on whole texts.

Words of ASCII and Latin-1 letters skip the tokenizer's normaliser and pre-tokeniser, which take most of its time:
composition leaves them as they are, lower case and its pattern are applied here, and the model gets the pieces.
"""

from __future__ import annotations

import json
import os
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex

#: Words remembered per Python worker, about 200 bytes each.
MEMO = 200_000
#: Bytes of text in a block; a longer text is encoded in parts of about this size.
BLOCK = 1 << 20
#: Characters that no Unicode version composes, and whose lower case and classes have always been the same.
_STABLE = regex.compile(r"[\x00-\x7f\xc0-\xff]*")


def _steps(node: dict | None, key: str) -> list[dict]:
    return [] if not node else node.get(key, [node])


def exact_by_words(path: str) -> bool:
    with open(path, encoding="utf-8") as f:
        t = json.load(f)
    kinds = {x["type"] for x in _steps(t.get("normalizer"), "normalizers")}
    pre = _steps(t.get("pre_tokenizer"), "pretokenizers")
    splits = [x for x in pre if x["type"] == "Split"]
    plain = all(x["type"] in ("Split", "ByteLevel") and not x.get("add_prefix_space") and not x.get("use_regex") for x in pre)
    drops = bool(splits) and splits[0]["behavior"] == "Removed" and splits[0]["invert"] and "\\s" in splits[0]["pattern"].get("Regex", "") and not any(x["content"].strip() != x["content"] or x["lstrip"] or x["rstrip"] for x in t["added_tokens"])
    return kinds <= {"NFC", "Replace", "Lowercase"} and plain and drops


class Encoder:
    """Texts to ids, little-endian unsigned integers of `width` bytes."""

    def __init__(self, path: str, width: int = 4, memo: int = MEMO) -> None:
        from tokenizers import Tokenizer

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        self.tokenizer, self.by_words = Tokenizer.from_file(path), exact_by_words(path)
        self.dtype, self.known, self.memo = np.dtype(f"<u{width}"), {}, memo
        if width < 4 and self.tokenizer.get_vocab_size() > 1 << 8 * width:
            raise ValueError(f"ids don't fit in {width} bytes")
        t = json.loads(self.tokenizer.to_str())
        pre = _steps(t["pre_tokenizer"], "pretokenizers")
        self.pieces, self.special = None, tuple(x["content"] for x in t["added_tokens"])
        suffix = t["model"].get("end_of_word_suffix") if t["model"]["type"] == "BPE" else None
        if self.by_words and suffix and [x["type"] for x in pre] == ["Split", "ByteLevel"]:
            self.lower = any(x["type"] == "Lowercase" for x in _steps(t["normalizer"], "normalizers"))
            self.pattern = regex.compile(pre[0]["pattern"]["Regex"])
            t |= {"normalizer": None, "added_tokens": [], "post_processor": None, "pre_tokenizer": {"type": "Sequence", "pretokenizers": [{"type": "WhitespaceSplit"}, pre[1]]}}
            self.pieces = Tokenizer.from_str(json.dumps(t))
            self.ends = np.zeros(self.pieces.get_vocab_size(), bool)
            self.ends[[i for x, i in t["model"]["vocab"].items() if x.endswith(suffix)]] = True

    def _whole(self, texts: list[str]) -> list[bytes]:
        out: list[bytes] = []
        for i in range(0, len(texts), 2048):  # an encoding takes far more room than its ids
            out += [np.array(e.ids, self.dtype).tobytes() for e in self.tokenizer.encode_batch_fast(texts[i : i + 2048], add_special_tokens=False)]
        return out

    def _words(self, words: list[str]) -> list[bytes]:
        """Ids of each word, words without white space."""
        if self.pieces is None:
            return self._whole(words)
        done, every = {}, " ".join(words)
        if not _STABLE.fullmatch(every) or any(x in every for x in self.special):
            odd = [w for w in words if not _STABLE.fullmatch(w) or any(x in w for x in self.special)]
            done = dict(zip(odd, self._whole(odd)))
        find = self.pattern.findall
        cut = [(w,) if w.isalpha() else find(w) for w in (words if not self.lower else map(str.lower, words))]
        new = list(dict.fromkeys(p for x in cut for p in x))
        ids = {}
        for i in range(0, len(new), 1024):
            part = new[i : i + 1024]
            got = np.array(self.pieces.encode(" ".join(part), add_special_tokens=False).ids, self.dtype)
            at = (np.flatnonzero(self.ends[got]) + 1).tolist()  # a piece's last token alone carries the end mark
            ids.update(zip(part, [got[a:z].tobytes() for a, z in zip([0, *at], at)] if len(at) == len(part) else self._whole(part)))
        out = [ids[x[0]] if len(x) == 1 else b"".join([ids[p] for p in x]) for x in cut]
        return [done.get(w, x) for w, x in zip(words, out)] if done else out

    def _ids(self, words: list[bytes]) -> list[bytes]:
        out = list(map(self.known.get, words))
        new = [w for w, x in zip(words, out) if x is None]
        if new:
            got: list[bytes] = []
            for i in range(0, len(new), 50_000):
                got += self._words([w.decode("utf-8", "replace") for w in new[i : i + 50_000]])
            room = max(0, self.memo - len(self.known))
            self.known.update(zip(new[:room], got))
            rest = iter(got)
            out = [next(rest) if x is None else x for x in out]
        return out

    def block(self, texts: pa.Array, end: int | None = None) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all texts one after the other, n + 1 offsets in them); `end`, if given, is appended to each text.
        texts: strings without nulls."""
        last = b"" if end is None else np.array([end], self.dtype).tobytes()
        if not self.by_words:
            own = [x + last for t in texts for x in self._whole([t.as_py()])]
            return np.frombuffer(b"".join(own), self.dtype), np.cumsum([0, *[len(x) // self.dtype.itemsize for x in own]])
        if self.pieces is not None and self.lower:
            low = pc.ascii_lower(texts)
            if not any(pc.any(pc.match_substring(low, x.lower())).as_py() for x in self.special):
                texts = low  # fewer different words
        split = pc.ascii_split_whitespace(texts)
        bounds = split.offsets.to_numpy().astype(np.int64)
        # an empty text, or white space at an end, gives empty words
        named = split.flatten().dictionary_encode()
        index, words = named.indices.to_numpy(), _bytes(named.dictionary)
        own = [*self._ids(words), last]
        pool, sizes = np.frombuffer(b"".join(own), self.dtype), np.fromiter(map(len, own), np.int64, len(own)) // self.dtype.itemsize
        bounds -= bounds[0]
        order = np.insert(index, bounds[1:], len(words))
        bounds += np.arange(len(bounds))
        n = sizes[order]
        ends = np.concatenate([[0], np.cumsum(n)])
        at = np.repeat((np.cumsum(sizes) - sizes)[order] - ends[:-1], n)
        at += np.arange(len(at))
        return pool[at], ends[bounds]

    def texts(self, column: pa.Array, end: int | None = None) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        """Blocks of a column of strings, null as empty: (number of texts, their ids, n + 1 offsets). A text of more
        than a block is encoded in parts, cut at ASCII white space."""
        column = pc.fill_null(column, "")
        sizes = pc.binary_length(column).to_numpy().astype(np.int64)
        first, held = 0, 0
        for i, s in enumerate(sizes.tolist()):
            if i > first and held + s > BLOCK:
                yield i - first, *self.block(column.slice(first, i - first), end)
                first, held = i, 0
            held += s
            if s > BLOCK and self.by_words:
                ids = [self.block(pa.array([p], pa.large_string()))[0] for p in _parts(column[i].as_py().encode("utf-8", "replace"))]
                ids += [np.array([end], self.dtype)] * (end is not None)
                flat = np.concatenate(ids)
                yield 1, flat, np.array([0, len(flat)])
                first, held = i + 1, 0
        if first < len(column):
            yield len(column) - first, *self.block(column.slice(first), end)

    def __call__(self, texts: list[bytes]) -> list[bytes]:
        """Ids of each text, as bytes."""
        column = pa.array([t.decode("utf-8", "replace") for t in texts], pa.large_string())
        return [flat[a:z].tobytes() for _, flat, bounds in self.texts(column) for a, z in zip(bounds, bounds[1:])]


_SPACE = regex.compile(rb"[\x20\x09-\x0d]")


def _parts(text: bytes) -> Iterator[bytes]:
    a = 0
    while a < len(text):
        cut = _SPACE.search(text, a + BLOCK)
        z = cut.start() if cut else len(text)
        yield text[a:z]
        a = z


def _bytes(words: pa.Array) -> list[bytes]:
    """The strings, none of which has a line end, as bytes."""
    if not len(words):
        return []
    one = pa.ListArray.from_arrays(pa.array([0, len(words)], pa.int32()), words.cast(pa.binary()))
    return pc.binary_join(one, b"\n")[0].as_py().split(b"\n")


@lru_cache(2)
def encoder(path: str, width: int = 4) -> Encoder:
    """One per Python worker, reused by its later tasks."""
    return Encoder(path, width)


def blocks(column, most: int = 4 << 20):
    """Lists of the texts of an Arrow column as bytes, null as empty, of about `most` bytes together at most, or one text."""
    block, held = [], 0
    for x in column.cast(pa.large_binary()):
        t = x.as_py() or b""
        if block and held + len(t) > most:
            yield block
            block, held = [], 0
        block.append(t)
        held += len(t)
    if block:
        yield block
