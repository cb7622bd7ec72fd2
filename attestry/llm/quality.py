"""Quality rules combined by weak supervision.

Each rule looks at one property of a text and votes good (1), bad (-1) or abstains (0).
Rules come in groups, one a fault. A latent-class model of each group says how often its
rules vote each way on texts with and without the fault; it is fitted by
expectation-maximisation on all texts, without labels. A text is good with the probability
that it has none of the faults, and is kept when that is at least one half and it passes
the two base limits.

Votes are few, so texts are counted by their vector of votes; there are at most
``3 ** len(RULES)`` vectors whatever the input, and the models are fitted to those counts.

Rules of a group look at one fault from near, so their votes agree more than independent ones
would and the fitted accuracies are somewhat high; what decides is the side they take.

Defined cases: a null or empty text has no words and fails the base limits; texts of any
length are taken whole; rows that repeat are counted and judged each for itself; an empty
table gives an empty result; where a group abstains its prior decides, and a probability of
exactly one half keeps; other columns are ignored, whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from attestry.llm import words as W

MIN_WORDS = 50
MAX_REPEAT_PERCENT = 50
_SYMBOLS = np.zeros(256, bool)
_SYMBOLS[np.frombuffer(b"#*$%&|<>", np.uint8)] = True
_CONTINUES = np.zeros(256, bool)  # bytes that do not begin a code point
_CONTINUES[0x80:0xC0] = True
_UPPER = np.zeros(256, bool)
_UPPER[65:91] = True
_LETTER = np.zeros(256, bool)
_LETTER[65:91] = _LETTER[97:123] = True
_LETTER[0xC3:0xE0] = True  # leads of two-byte letters

FEATURES = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_upper", "n_letters", "n_distinct", "n_symbol_words", "n_upper_words", "n_bangs")


def _per_row(offsets: np.ndarray, mask: np.ndarray) -> np.ndarray:
    sums = np.concatenate(([0], np.cumsum(mask)))
    return sums[offsets[1:]] - sums[offsets[:-1]]


def _by_row(row: np.ndarray, weight: np.ndarray, n: int) -> np.ndarray:
    return np.bincount(row, weight, n).astype(np.int64)


def _again(row: np.ndarray, key: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Per item: does it repeat a key that its row has had (all but one of equal items), and is
    its key in its row more than once."""
    joint = W.mix(key + row.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))
    order = np.argsort(joint)
    sorted_ = joint[order]
    same = np.zeros(len(key), bool)
    same[1:] = sorted_[1:] == sorted_[:-1]
    repeat, several = np.empty(len(key), bool), np.empty(len(key), bool)
    repeat[order] = same
    same[:-1] |= same[1:]
    several[order] = same
    return repeat, several


def features(words: W.Words) -> dict[str, np.ndarray]:
    """FEATURES of each row, as int64 arrays."""
    data, offsets, n = words.data, words.offsets, len(words.count)
    h = words.hashes()
    length = np.concatenate(([0], np.cumsum(~_CONTINUES[data])))
    # lines: spans of words between \n; equal lines have equal bytes
    breaks = np.flatnonzero(data == 10)
    start = np.unique(np.concatenate((offsets[:-1], breaks + 1)))
    start = start[start < len(data)]
    end = np.append(start[1:], len(data))[: len(start)]
    end -= (data[end - 1] == 10).astype(np.int64) if len(end) else 0
    worded = np.searchsorted(words.start, end) > np.searchsorted(words.start, start)
    start, end = start[worded], end[worded]
    row = np.searchsorted(offsets[1:], start, "right")
    line = W.byte_hash(data, start, end)
    dup, _ = _again(row, line)
    # three-word windows found twice or more cover their words
    at = words.windows(3)
    _, twice = _again(words.row[at], W.sequence_hash(h, at, at + 3))
    cover = np.zeros(len(h) + 3, np.int64)
    for k in range(3):
        cover[at[twice] + k] = 1
    seen, _ = _again(words.row, h)
    symbols, upper, letters = (np.concatenate(([0], np.cumsum(m[data]))) for m in (_SYMBOLS, _UPPER, _LETTER))
    has_symbol = symbols[words.end] > symbols[words.start]
    all_upper = (upper[words.end] - upper[words.start] > 1) & (upper[words.end] - upper[words.start] == letters[words.end] - letters[words.start])
    return {
        "n_words": words.count,
        "word_chars": _by_row(words.row, length[words.end] - length[words.start], n),
        "n_symbols": symbols[offsets[1:]] - symbols[offsets[:-1]],
        "n_dup_lines": _by_row(row, dup, n),
        "n_repeat_words": _by_row(words.row, cover[: len(h)], n),
        "n_lines": np.bincount(row, minlength=n),
        "n_upper": upper[offsets[1:]] - upper[offsets[:-1]],
        "n_letters": letters[offsets[1:]] - letters[offsets[:-1]],
        "n_distinct": words.count - _by_row(words.row, seen, n),
        "n_symbol_words": _by_row(words.row, has_symbol, n),
        "n_upper_words": _by_row(words.row, all_upper, n),
        "n_bangs": _per_row(offsets, data == 33),
    }


def measured(docs: DataFrame, text_col: str = "text", keep_text: bool = False, into: str = "_features") -> DataFrame:
    """``docs`` with FEATURES in a struct ``into``, and without the text unless asked to keep it."""
    names = [c for c in docs.columns if keep_text or c != text_col]
    where = docs.columns.index(text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at, to, words in W.blocks(batch.column(where).cast(pa.large_string())):
                part, found = batch.slice(at, to - at), features(words)
                struct = pa.StructArray.from_arrays([pa.array(found[f].astype(np.int64)) for f in FEATURES], names=list(FEATURES))
                columns = [part.column(i) for i, c in enumerate(part.schema.names) if keep_text or i != where]
                yield pa.record_batch([*columns, struct], names=[*names, into])

    schema = T.StructType([f for f in docs.schema if f.name in names])
    return docs.mapInArrow(run, schema.add(into, T.StructType([T.StructField(f, T.LongType()) for f in FEATURES])))


def _ratio(of: str, by: str, at: str) -> Column:
    return F.col(f"{at}.{of}") / F.greatest(F.col(f"{at}.{by}"), F.lit(1))


#: fault: {rule: (property, at most: good, at least: bad)}, or the reverse where good is higher.
#: Each fault is seen by three rules, so that their agreement tells how good they are.
FAULTS: dict[str, dict[str, tuple[tuple[str, str], float, float]]] = {
    "symbols": {
        "symbols": (("n_symbols", "n_words"), 0.05, 0.25),
        "symbol_words": (("n_symbol_words", "n_words"), 0.05, 0.2),
        "symbol_chars": (("n_symbols", "word_chars"), 0.01, 0.04),
    },
    "repetition": {
        "dup_lines": (("n_dup_lines", "n_lines"), 0.2, 0.35),
        "repeats": (("n_repeat_words", "n_words"), 0.3, 0.4),
        "distinct": (("n_distinct", "n_words"), 0.3, 0.15),
    },
    "shouting": {
        "upper": (("n_upper", "n_letters"), 0.2, 0.4),
        "upper_words": (("n_upper_words", "n_words"), 0.1, 0.3),
        "bangs": (("n_bangs", "n_words"), 0.05, 0.2),
    },
}
RULES = {name: rule for group in FAULTS.values() for name, rule in group.items()}


def vote(rule: str, at: str = "_features") -> Column:
    """1, -1 or 0; a text without words has no vote. ``at`` is the struct of FEATURES."""
    (of, by), good, bad = RULES[rule]
    r = _ratio(of, by, at)
    up, down = (r <= good, r >= bad) if good < bad else (r >= good, r <= bad)
    return F.when(F.col(f"{at}.n_words") == 0, 0).when(up, 1).when(down, -1).otherwise(0)


def fit(patterns: np.ndarray, counts: np.ndarray, rounds: int = 200, prior: float = 0.95) -> tuple[float, np.ndarray]:
    """EM for P(no fault) and P(vote | class): an array [class, rule, vote + 1], class 1 without.

    It begins from rules that are right nine times in ten when they vote, which settles
    which class is which. A pseudo-count of one vote of that kind keeps rules that never
    vote defined.
    """
    start = np.empty((2, patterns.shape[1], 3))
    start[1], start[0] = (0.05, 0.15, 0.8), (0.8, 0.15, 0.05)
    table, p = start.copy(), prior
    onehot = np.stack([patterns == v for v in (-1, 0, 1)], 2).astype(float)
    for _ in range(rounds):
        post = posterior(patterns, p, table)
        for c, w in ((1, post * counts), (0, (1 - post) * counts)):
            got = np.einsum("i,irv->rv", w, onehot) + start[c]
            table[c] = got / got.sum(1, keepdims=True)
        new = float(np.clip((post * counts).sum() / max(counts.sum(), 1), 0.5, 0.999))
        if abs(new - p) < 1e-9:
            break
        p = new
    return p, table


def posterior(patterns: np.ndarray, p: float, table: np.ndarray) -> np.ndarray:
    at = np.arange(patterns.shape[1])
    good = np.log(p) + np.log(table[1, at, patterns + 1]).sum(1)
    bad = np.log(1 - p) + np.log(table[0, at, patterns + 1]).sum(1)
    return 1 / (1 + np.exp(np.clip(bad - good, -700, 700)))


def fit_all(patterns: np.ndarray, counts: np.ndarray) -> list[tuple[slice, float, np.ndarray]]:
    """A group's place among RULES and its fitted model, for each group."""
    out, at = [], 0
    for group in FAULTS.values():
        own = slice(at, at + len(group))
        seen, index = np.unique(patterns[:, own], axis=0, return_inverse=True)
        p, table = fit(seen, np.bincount(index.ravel(), counts, len(seen)))
        out.append((own, p, table))
        at += len(group)
    return out


def _verdict(texts: DataFrame, text_col: str, at: str = "_features") -> tuple[Column, Column, Column]:
    """base_failed, p_good and kept as expressions over the struct ``at``; fits the model on all ``texts``."""
    rows = measured(texts.select(F.col(text_col).cast("string").alias("text"))).where("_features.n_words > 0")
    seen = rows.groupBy(*(vote(r).alias(r) for r in RULES)).count().collect()  # 3 ** len(RULES) rows at most
    patterns = np.array([[x[r] for r in RULES] for x in seen], int).reshape(len(seen), len(RULES))
    good, names = F.lit(1.0), list(RULES)
    for own, p, table in fit_all(patterns, np.array([x["count"] for x in seen], float)):
        odds = F.lit(float(np.log(p / (1 - p))))
        for i, rule in enumerate(names[own]):
            bad_, none_, good_ = (float(x) for x in np.log(table[1, i] / table[0, i]))
            odds = odds + F.when(vote(rule, at) == 1, good_).when(vote(rule, at) == -1, bad_).otherwise(none_)
        good = good / (1 + F.exp(-odds))
    n_words = F.col(f"{at}.n_words")
    failed = (n_words < MIN_WORDS) | (100 * F.col(f"{at}.n_repeat_words") > MAX_REPEAT_PERCENT * n_words)
    return failed, good, ~failed & (good >= 0.5)


def judged(docs: DataFrame, key: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``key``, FEATURES, base_failed, p_good and kept of every row."""
    failed, good, kept = _verdict(docs, text_col)
    rows = measured(docs.select(key, F.col(text_col).cast("string").alias("_text")), "_text")
    return rows.select(key, "_features.*", failed.alias("base_failed"), good.alias("p_good"), kept.alias("kept"))


def filtered(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that are kept, with their own columns, whatever their names."""
    into = "_features"
    while into in docs.columns:
        into += "_"
    _, _, kept = _verdict(docs, text_col, into)
    return measured(docs, text_col, keep_text=True, into=into).where(kept).drop(into)
