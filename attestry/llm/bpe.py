"""Byte-pair encoding of whole texts: speculate, verify, and merge only what fails.

The vocabulary and merges come from a tokenizer file (a parameter). Texts are normalised (NFC,
one space for white space, lower case character by character) and cut into pieces by one
pattern; a file that asks for anything else is refused.

1. Greedy longest match proposes tokens for each distinct piece.
2. A proposal is right exactly when every adjacent pair of its tokens is: both tokens encode
   to themselves, and no merge between the left one's right edge and the right one's left
   edge would come before the merges that close those edges. The edges of all pairs are
   looked up together, in numpy.
3. A piece with a pair that fails is merged exactly, lowest rank first, leftmost first.

Equal chunks between white space are encoded once while a task remembers them: it keeps the
``KEEP`` chunks it met last, at most twice as many, and as many pieces of chunks, so memory does not follow the input.

Defined cases: a null text counts as empty; empty texts have no tokens and decode to the
empty string; special tokens in a text are their own ids; equal ranks are merged leftmost
first; rows that repeat are encoded each for itself; texts of any length are taken whole; an
empty table gives an empty result; other columns are ignored, whatever their names.
"""

from __future__ import annotations

import hashlib
import heapq
import json
import unicodedata
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Chunks whose encodings a task keeps.
KEEP = 250_000
#: Characters that a longest match is looked up by.
HEAD = 4
#: Longest text that is worked on with others, in bytes of a group.
GROUP = 2 << 20

# white space of the pre-tokenizer's pattern (fixed values)
_SPACE = "".join(map(chr, [9, 10, 11, 12, 13, 32, 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000]))
_ENDINGS = "'s|'t|'re|'ve|'m|'ll|'d"


# letters and digits of the regex module that the pre-tokenizer's tables do not have (fixed values)
_NEWER = (
    "558-558 58b-58c 88f-88f c5c-c5c cdc-cdc 208f-208f 209d-209f a7ce-a7cf a7d2-a7d2 a7d4-a7d4 a7dd-a7dd a7e2-a7e2 a7f1-a7f1 "
    "ab6c-ab6d 107bb-107bf 10940-10959 10ec5-10ec7 10ed9-10eee 11b0a-11b0a 11db0-11ddb 11df1-11df1 16ea0-16eb8 "
    "16ebb-16ed3 16ff2-16ff3 187f8-187ff 18cd6-18cda 18d09-18d20 18d80-18df2 18e00-19191 191a0-191d2 1b123-1b128 "
    "1b168-1b168 1d6a6-1d6a6 1df1f-1df24 1df2b-1df81 1df90-1df96 1dfcd-1dfff 1e6c0-1e6de 1e6e0-1e6e2 1e6e4-1e6e5 "
    "1e6e7-1e6ed 1e6f0-1e6f4 1e6fe-1e6ff 2b73a-2b73f 2b81e-2b81e 2cea2-2cead 323b0-33479 3d000-3fc3f "
)
# lower case that Python's tables do not have (fixed values)
_LOWER = {0x03A3: 0x03C3, 0x1C89: 0x1C8A, 0xA7CB: 0x0264, 0xA7CC: 0xA7CD, 0xA7CE: 0xA7CF, 0xA7D2: 0xA7D3, 0xA7D4: 0xA7D5, 0xA7DA: 0xA7DB, 0xA7DC: 0x019B}
_LOWER |= {c: c + 0x20 for c in range(0x10D50, 0x10D66)} | {c: c + 0x1B for c in range(0x16EA0, 0x16EB9)}
_LOWER_KEYS = regex.compile("[" + "".join(map(chr, _LOWER)) + "]")  # few texts have one, and a table of all characters is slow
_NOT = "".join("\\U{:0>8}-\\U{:0>8}".format(*r.split("-")) for r in _NEWER.split())

_ASCII_PIECE = regex.compile(rf"{_ENDINGS}|[a-z]+|[0-9]|[^\s0-9a-z]+")
_PIECE = regex.compile(rf"(?V1){_ENDINGS}|[\p{{L}}--[{_NOT}]]+|[\p{{N}}--[{_NOT}]]|[^{_SPACE}[\p{{L}}\p{{N}}--[{_NOT}]]]+")
_ODD_SPACE = regex.compile(r"[\x1c-\x1f]")
_SPLIT = regex.compile(rf"[{_SPACE}]+")


def byte_characters() -> list[str]:
    """The printable character that stands for each byte: itself, or the next above 255."""
    shown = {*range(33, 127), *range(161, 173), *range(174, 256)}
    spare = iter(range(256, 512))
    return [chr(b if b in shown else next(spare)) for b in range(256)]


#: What a tokenizer file must say of normalising and cutting, for this module does only that (fixed values).
_NORMALIZER = {"type": "Sequence", "normalizers": [{"type": "NFC"}, {"type": "Replace", "pattern": {"Regex": r"\s+"}, "content": " "}, {"type": "Lowercase"}]}
_CUTS = {"type": "Split", "pattern": {"Regex": r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"}, "behavior": "Removed", "invert": True}
_BYTES = {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": False}


def check(spec: dict) -> None:
    """Refuse a tokenizer file whose rules this module does not follow."""
    model = spec["model"]
    wrong = [
        name
        for name, ok in {
            "model": model.get("type") == "BPE" and not any(model.get(k) for k in ("dropout", "unk_token", "continuing_subword_prefix", "fuse_unk", "byte_fallback", "ignore_merges")),
            "normalizer": spec.get("normalizer") == _NORMALIZER,
            "pre_tokenizer": spec.get("pre_tokenizer") == {"type": "Sequence", "pretokenizers": [_CUTS, _BYTES]},
            "decoder": spec.get("decoder") is None,
            "added_tokens": not any(t.get(k) for t in spec["added_tokens"] for k in ("single_word", "lstrip", "rstrip", "normalized")),
        }.items()
        if not ok
    ]
    if wrong:
        raise ValueError(f"tokenizer file with other rules than this module's: {', '.join(wrong)}")


class Encoder:
    def __init__(self, text: str) -> None:
        spec = json.loads(text)
        check(spec)
        model = spec["model"]
        self.ids: dict[str, int] = dict(model["vocab"])
        self.suffix: str = model.get("end_of_word_suffix") or ""
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.ids |= self.special
        self.text = dict(sorted((i, t) for t, i in self.ids.items()))
        pairs = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in model["merges"]]
        self.rank: dict[tuple[str, str], int] = {}
        for r, p in enumerate(pairs):
            self.rank.setdefault(p, r)
        self.byte = byte_characters()
        self.longest: dict[str, int] = {}  # by a token's first ``HEAD`` characters; shorter tokens are not in it
        for token in self.ids:
            if len(token) >= HEAD:
                self.longest[token[:HEAD]] = max(self.longest.get(token[:HEAD], 0), len(token))
        self._special_split = regex.compile("(" + "|".join(map(regex.escape, sorted(self.special, key=len, reverse=True))) + ")") if self.special else None
        self._edges()
        self.known: dict[str, tuple[str, str, int]] = {}
        self.older: dict[str, tuple[str, str, int]] = {}
        self.pieces: dict[str, tuple[str, str, int]] = {}

    def _edges(self) -> None:
        """Right and left edges of each token: the nested tokens there and the rank that closes each."""
        size = max(self.text) + 1
        parent: dict[str, tuple[str, str, int]] = {}
        self.sound = np.zeros(size, bool)
        for token, i in self.ids.items():
            if len(self.symbols_of(token)) == 1:
                self.sound[i] = True
        for (a, b), r in self.rank.items():  # in order of rank: the parts come before the whole
            whole = a + b
            if whole in parent or whole not in self.ids:
                continue
            parent[whole] = (a, b, r)
        never = len(self.rank)
        depth = 1
        edges: dict[bool, dict[str, list[tuple[int, int]]]] = {True: {}, False: {}}
        order = sorted(parent.items(), key=lambda x: x[1][2])
        for right in (True, False):
            table = edges[right]
            for token in self.ids:
                if token not in parent:
                    table[token] = [(self.ids[token], never)]
            for token, (a, b, r) in order:
                inner = table.get(b if right else a, [(self.ids[b if right else a], never)])
                table[token] = [(self.ids[token], never), (inner[0][0], r), *inner[1:]]
                depth = max(depth, len(table[token]))
        self.right, self.left = (np.full((size, depth, 2), -1, np.int64) for _ in range(2))
        for array, right in ((self.right, True), (self.left, False)):
            for token, edge in edges[right].items():
                array[self.ids[token], : len(edge)] = edge
        codes = sorted((self.ids[a] * size + self.ids[b], r) for (a, b), r in self.rank.items())
        self._pair_code = np.array([c for c, _ in codes], np.int64)
        self._pair_rank = np.array([r for _, r in codes], np.int64)
        self._size = size
        # a token is sound when its own two parts stay whole until they meet
        ids = np.array([[self.ids[t], self.ids[a], self.ids[b], r] for t, (a, b, r) in order], np.int64)
        if len(ids):
            apart = self.compatible(ids[:, 1], ids[:, 2], ids[:, 3])
            for (t, a, b, _), ok in zip(ids.tolist(), apart.tolist(), strict=True):
                self.sound[t] = ok and self.sound[a] and self.sound[b]

    def symbols_of(self, token: str) -> list[str]:
        """Single characters, the last with the suffix."""
        if self.suffix and token.endswith(self.suffix) and len(token) > len(self.suffix):
            stem = token[: -len(self.suffix)]
            return [*stem[:-1], stem[-1] + self.suffix]
        return list(token)

    def compatible(self, a: np.ndarray, b: np.ndarray, until: np.ndarray | None = None) -> np.ndarray:
        """Whether tokens a and b, side by side, stay as they are (up to the merge of rank ``until``)."""
        ok = np.ones(len(a), bool)
        for i in range(self.right.shape[1]):
            x, x_closed = self.right[a, i].T
            if (x < 0).all():
                break
            for j in range(self.left.shape[1]):
                y, y_closed = self.left[b, j].T
                there = (x >= 0) & (y >= 0)
                if not there.any():
                    break
                code = np.where(there, x * self._size + y, -1)
                at = np.minimum(np.searchsorted(self._pair_code, code), len(self._pair_code) - 1)
                hit = self._pair_code[at] == code
                rank = self._pair_rank[at]
                early = hit & (rank < x_closed) & (rank <= y_closed)
                if until is not None:
                    early &= rank < until
                ok &= ~early
        return ok

    def merged(self, symbols: list[str]) -> list[int]:
        """Exact merging: lowest rank first, then leftmost."""
        if len(symbols) > 200:
            return self._merged_long(symbols)
        token, rank, none = list(symbols), self.rank.get, len(self.rank)
        ranks = [rank(p, none) for p in zip(token, token[1:], strict=False)]
        while ranks and (r := min(ranks)) < none:
            i = ranks.index(r)
            token[i : i + 2] = [token[i] + token[i + 1]]
            del ranks[i]
            if i:
                ranks[i - 1] = rank((token[i - 1], token[i]), none)
            if i < len(ranks):
                ranks[i] = rank((token[i], token[i + 1]), none)
        return [self.ids[t] for t in token if t in self.ids]

    def _merged_long(self, symbols: list[str]) -> list[int]:
        """The same by a heap, for words of any length."""
        token, after, before = list(symbols), [*range(1, len(symbols)), -1], [-1, *range(len(symbols) - 1)]
        heap = [(self.rank[p], i) for i, p in enumerate(zip(token, token[1:], strict=False)) if p in self.rank]
        heapq.heapify(heap)
        while heap:
            r, i = heapq.heappop(heap)
            j = after[i]
            if not token[i] or j < 0 or self.rank.get((token[i], token[j])) != r:
                continue
            token[i] += token[j]
            token[j] = ""
            after[i] = after[j]
            if after[i] >= 0:
                before[after[i]] = i
            for left, right in ((before[i], i), (i, after[i])):
                if left >= 0 and right >= 0 and (p := (token[left], token[right])) in self.rank:
                    heapq.heappush(heap, (self.rank[p], left))
        return [self.ids[t] for t in token if t and t in self.ids]

    def proposed(self, symbols: list[str]) -> list[int] | None:
        """Greedy longest match; None when a symbol has no token."""
        word, out, at, ids, longest = "".join(symbols), [], 0, self.ids, self.longest
        end, stem = len(word), len(word) - len(self.suffix)
        while at < end:
            most = at + longest.get(word[at : at + HEAD], HEAD - 1)
            if most >= end and (i := ids.get(word[at:])) is not None:
                out.append(i)
                return out
            for to in range(min(stem, most), at, -1):
                if (i := ids.get(word[at:to])) is not None:
                    out.append(i)
                    at = to
                    break
            else:
                return None
        return out

    def encode_pieces(self, pieces: list[str]) -> list[list[int]]:
        """Token ids of each piece (already normalised and cut)."""
        symbols = []
        for piece in pieces:
            s = [self.byte[b] for b in piece.encode()]
            s[-1] += self.suffix
            symbols.append(s)
        found = [self.proposed(s) for s in symbols]
        flat = np.array([i for f in found if f for i in f], np.int64)
        length = np.array([len(f) if f else 0 for f in found])
        owner = np.repeat(np.arange(len(found)), length)
        bad = length == 0
        np.logical_or.at(bad, owner[~self.sound[flat]], True)
        inner = owner[1:] == owner[:-1]
        code, back = np.unique(flat[:-1][inner] * self._size + flat[1:][inner], return_inverse=True)
        wrong = ~self.compatible(code // self._size, code % self._size)[back]
        np.logical_or.at(bad, owner[1:][inner][wrong], True)
        for i in np.flatnonzero(bad):
            found[i] = self.merged(symbols[i])
        return found

    def learn(self, chunks: list[str]) -> None:
        """Encode chunks (normalised, without white space) that are not known."""
        cut = [(_ASCII_PIECE if c.isascii() else _PIECE).findall(c) for c in chunks]
        of = self.pieces
        fresh = [p for p in {p for c in cut for p in c} if p not in of]
        if len(of) + len(fresh) > 2 * KEEP:  # chunks of this call still need theirs
            of = self.pieces = {p: of[p] for c in cut for p in c if p in of}
        text = self.text
        for piece, ids in zip(fresh, self.encode_pieces(fresh) if fresh else [], strict=True):
            of[piece] = " ".join(map(str, ids)), " ".join([text[i] for i in ids]), len(ids)
        for chunk, parts in zip(chunks, cut, strict=True):
            self.known[chunk] = of[parts[0]] if len(parts) == 1 else _joined([of[p] for p in parts])

    def chunks(self, text: str) -> list[str]:
        """The text's parts between white space, normalised; special tokens stand alone."""
        parts = self._special_split.split(text) if self._special_split and any(map(text.__contains__, self.special)) else [text]
        out = []
        for k, part in enumerate(parts):
            if k % 2:
                out.append(" " + part)  # no other chunk begins with a space
                continue
            if not part.isascii():
                part = unicodedata.normalize("NFC", part)
                part = part.translate(_LOWER) if _LOWER_KEYS.search(part) else part
            part = part.lower()
            out += [c for c in _SPLIT.split(part) if c] if _ODD_SPACE.search(part) else part.split()
        return out

    def encode(self, texts: list[str]) -> list[tuple[str, str, int]]:
        """(ids joined by a space, decoded text, number of ids) of each text."""
        cut = [self.chunks(t) for t in texts]
        distinct = set().union(*cut)
        if len(self.known) > KEEP:
            self.older, self.known = self.known, {}
        self.known |= {" " + t: (str(i), t, 1) for t, i in self.special.items()}
        new = distinct.difference(self.known)
        self.known |= {c: self.older[c] for c in new if c in self.older}
        self.learn([c for c in new if c not in self.older])
        known = self.known.__getitem__
        return [_joined(list(map(known, c))) for c in cut]


def _joined(parts: list[tuple[str, str, int]]) -> tuple[str, str, int]:
    """(ids, decoded text, number of ids) of parts that follow each other."""
    ids, decoded, n = zip(*parts, strict=True) if parts else ((), (), ())
    if 0 in n:  # a part of which the pattern or the vocabulary keeps nothing
        ids, decoded = filter(None, ids), filter(None, decoded)
    return " ".join(ids), " ".join(decoded), sum(n)


_encoders: dict[str, Encoder] = {}


def content(path: str) -> str:
    with open(path, encoding="utf-8") as f:
        return f.read()


def encoder(path: str, text: Callable[[], str] | None = None) -> Encoder:
    """One encoder a Python process and content; ``text`` gives the file's content where the file is not."""
    spec = text() if text else content(path)
    key = hashlib.sha256(spec.encode()).hexdigest()
    if key not in _encoders:
        _encoders[key] = Encoder(spec)
    return _encoders[key]


def _groups(texts: pa.Array) -> Iterator[tuple[int, list[str]]]:
    held, size, at = [], 0, 0
    for i, t in enumerate(texts):
        held.append(t.as_py() or "")
        size += len(held[-1])
        if size >= GROUP:
            yield at, held
            held, size, at = [], 0, i + 1
    if held:
        yield at, held


def encoded(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id_col``, n_tokens, ids (decimal, joined by a space) and decoded of every row.

    The tokenizer file is read by the driver and broadcast (a few megabytes). ``decoded`` is what
    ``decoded`` gives for the ids, put together from chunks that a task has met before.
    """
    spec = docs.sparkSession.sparkContext.broadcast(content(path))
    check(json.loads(spec.value))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = encoder(path, lambda: spec.value)
        for batch in batches:
            for at, texts in _groups(batch.column(1)):
                ids, decoded, n = zip(*bpe.encode(texts), strict=True)
                yield pa.record_batch(
                    [batch.column(0).slice(at, len(texts)), pa.array(n, pa.int64()), pa.array(ids, pa.string()), pa.array(decoded, pa.string())],
                    names=["key", "n_tokens", "ids", "decoded"],
                )

    kind = dict(docs.dtypes)[id_col]
    texts = docs.select(F.col(id_col).alias("key"), F.col(text_col).cast("string").alias("text"))
    return texts.mapInArrow(run, f"key {kind}, n_tokens long, ids string, decoded string").withColumnRenamed("key", id_col)


def decoded(tokens: DataFrame, path: str, id_col: str = "doc_id", ids_col: str = "ids") -> DataFrame:
    """``id_col`` and decoded of every row of ids (decimal, joined by a space).

    Special tokens are kept; a null is no ids; an id that no token has is passed over.
    """
    spec = tokens.sparkSession.sparkContext.broadcast(content(path))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        text = encoder(path, lambda: spec.value).text
        for batch in batches:
            found = [" ".join([text[i] for i in map(int, (ids.as_py() or "").split()) if i in text]) for ids in batch.column(1)]
            yield pa.record_batch([batch.column(0), pa.array(found, pa.string())], names=["key", "decoded"])

    kind = dict(tokens.dtypes)[id_col]
    rows = tokens.select(F.col(id_col).alias("key"), F.col(ids_col).cast("string").alias("ids"))
    return rows.mapInArrow(run, f"key {kind}, decoded string").withColumnRenamed("key", id_col)
