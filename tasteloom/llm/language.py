"""Language identification by cross-parsing entropy.

A suffix automaton of each language's labelled text recognises every substring of
it. A document is cut greedily into the longest pieces the automaton knows
(a Ziv-Merhav cross-parse); the fewer pieces it takes, weighted by the bits that
point into the labelled text, the closer the document is to the language.

The automata are built from a bounded hash sample of the labelled rows: about
``rows`` rows of each language, ``chars_per_row`` characters of each and ``chars``
characters in all. Documents are parsed whole, restarting every ``PIECE`` letters
so that a very long text is as many independent lanes of one table walk.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache
from math import log2

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tasteloom.llm.common import doc_rows

PIECE = 4096
_LETTERS, _RARE = 120, 64   # letters with a class of their own, classes that share the others


def automaton(codes: list[int], alphabet: int) -> np.ndarray:
    """Transitions of the suffix automaton of ``codes``: a row per state, -1 where there is none; state 0 is the root."""
    step, link, depth = [{}], [-1], [0]
    last = 0
    for c in codes:
        new = len(step)
        step.append({})
        link.append(0)
        depth.append(depth[last] + 1)
        at = last
        while at != -1 and c not in step[at]:
            step[at][c] = new
            at = link[at]
        if at != -1:
            to = step[at][c]
            if depth[at] + 1 == depth[to]:
                link[new] = to
            else:
                copy = len(step)
                step.append(dict(step[to]))
                link.append(link[to])
                depth.append(depth[at] + 1)
                while at != -1 and step[at].get(c) == to:
                    step[at][c] = copy
                    at = link[at]
                link[to] = link[new] = copy
        last = new
    table = np.full((len(step), alphabet), -1, dtype=np.int64)
    for state, edges in enumerate(step):
        for c, to in edges.items():
            table[state, c] = to
    return table


def parse_table(codes: list[int], alphabet: int, first_state: int) -> np.ndarray:
    """The automaton as one step of the parse: 4 * (next state * alphabet) + pieces ended by the step."""
    table = automaton(codes, alphabet)
    root = table[0]
    again = np.where(root >= 0, root, 0)          # a piece ends, the next begins with the same letter
    ended = np.where(root >= 0, 1, 2)             # a letter the language never has is a piece by itself
    out = np.where(table >= 0, (table + first_state) * alphabet * 4, (again + first_state) * alphabet * 4 + ended)
    out[0] = np.where(root >= 0, (root + first_state) * alphabet * 4, first_state * alphabet * 4 + 1)
    return out.astype(np.int64)


@dataclass
class Model:
    """Labelled text per language in letter classes; tables are made where the model is used."""

    languages: list[str]
    letters: list[str]
    texts: list[str]

    def __post_init__(self):
        self.alphabet = 1 + len(self.letters) + _RARE
        self.codes = np.zeros(0x110000, dtype=np.uint8)
        letters = np.frombuffer(bytes(chr(i).isalpha() for i in range(0x110000)), dtype=np.bool_)
        points = np.nonzero(letters)[0]
        self.codes[points] = 1 + len(self.letters) + points % _RARE
        for i, letter in enumerate(self.letters):
            self.codes[ord(letter)] = 1 + i
        self.step, self.roots = np.zeros(0, dtype=np.int64), []
        parts, states = [], 0
        for text in self.texts:
            table = parse_table(self.encode(text).tolist(), self.alphabet, states)
            self.roots.append(states * self.alphabet)
            parts.append(table.ravel())
            states += len(table)
        if parts:
            self.step = np.concatenate(parts)
            self.step = self.step.astype(np.int32) if self.step.max() < 2**31 else self.step
        self.bits = np.array([log2(len(t) + 2) for t in self.texts])

    def encode(self, text: str) -> np.ndarray:
        """Letter classes; every run of anything else is one 0, none at the ends."""
        codes = self.codes[np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), dtype="<u4")]
        other = codes == 0
        if len(codes):
            codes = codes[~(other & np.concatenate([[True], other[:-1]]))]
        return codes[:-1] if len(codes) and codes[-1] == 0 else codes

    def pieces(self, texts: list[np.ndarray]) -> np.ndarray:
        """Pieces of each text's cross-parse by each language (texts x languages)."""
        owner, begin, length, start = [], [], [], 0
        for i, codes in enumerate(texts):
            for at in range(0, len(codes), PIECE):
                owner.append(i)
                begin.append(start + at)
                length.append(min(PIECE, len(codes) - at))
            start += len(codes)
        total = np.zeros((len(texts), len(self.languages)), dtype=np.int64)
        if not owner:
            return total
        flat = np.concatenate(texts).astype(np.int32)
        order = np.argsort(-np.array(length), kind="stable")
        length, begin, owner = np.array(length)[order], np.array(begin)[order], np.array(owner)[order]
        roots = np.array(self.roots, dtype=self.step.dtype)[:, None]
        at = np.repeat(roots, len(order), axis=1)
        ended = np.zeros(at.shape, dtype=np.int32)
        alive = np.searchsorted(-length, -np.arange(length[0]), side="left")  # lanes longer than t
        for t in range(int(length[0])):
            n = alive[t]
            step = self.step[at[:, :n] + flat[begin[:n] + t]]
            ended[:, :n] += step & 3
            at[:, :n] = step >> 2
        ended += at != roots
        for k in range(len(self.languages)):
            total[:, k] = np.bincount(owner, weights=ended[k], minlength=len(texts))
        return total

    def predict(self, texts: list[str | None]) -> tuple[list[str], list[float]]:
        """Language and score of each text; ties go to the language first in alphabetical order."""
        codes = [self.encode(t or "") for t in texts]
        cost = self.pieces(codes) * self.bits if self.languages else np.zeros((len(texts), 0))
        names, scores = [], []
        for row, text in zip(cost, codes):
            if not len(text) or not len(row):
                names.append("und")
                scores.append(0.0)
                continue
            best = int(np.argmin(row))
            rest = np.delete(row, best)
            names.append(self.languages[best])
            scores.append(float(1 - row[best] / rest.min()) if len(rest) else 1.0)
        return names, scores


def fit(labelled: DataFrame, label: str = "lang", rows: int = 200, chars: int = 40_000) -> Model:
    """Automata of each label's text, from a hash sample of about ``rows`` rows per label.

    A row gives one slice at a hash-chosen place of its text, so that any part of a text
    may be learnt; slices are as long as it takes for all of a label's to have ``chars``
    characters together, or whole texts where they are shorter. Rows that repeat both
    id and text count once; rows that share only an id are rows like any other. Rows
    without a label or a text are left out; no labelled row at all gives a model that
    answers ``und``.
    """
    data = doc_rows(labelled, label).filter(F.col(label).isNotNull() & F.col("text").isNotNull()).select(
        F.col(label).cast("string").alias("lang"), "text", F.xxhash64(F.lit("language"), "doc_id", "text").alias("o"))
    counts = {r["lang"]: r["n"] for r in data.groupBy("lang").agg(F.approx_count_distinct("o").alias("n")).collect()}
    chosen, width = F.lit(False), F.lit(0)
    for lang, n in counts.items():
        chosen |= (F.col("lang") == lang) & (F.pmod("o", F.lit(1 << 30)) < int((1 << 30) * min(1.0, rows / max(1, n))))
        width = F.when(F.col("lang") == lang, -(-chars // max(1, min(rows, n)))).otherwise(width)
    place = F.pmod(F.xxhash64(F.lit("place"), "o"), F.greatest(F.length("text") - width + 1, F.lit(1))) + 1
    sample = data.filter(chosen).select("lang", "o", F.substr("text", place.cast("int"), width).alias("text")).dropDuplicates(["lang", "o"])
    texts: dict[str, list[tuple[int, str]]] = {}
    for row in sample.collect():      # some ``rows`` slices, ``chars`` characters of each label
        texts.setdefault(row["lang"], []).append((row["o"], row["text"]))
    names = sorted(texts)
    joined = [" ".join(t for _, t in sorted(texts[n])) for n in names]
    seen = Counter(c for text in joined for c in text.lower() if c.isalpha())
    return Model(names, sorted(c for c, _ in seen.most_common(_LETTERS)), joined)


@lru_cache(maxsize=2)
def _built(languages: tuple, letters: tuple, texts: tuple) -> Model:
    return Model(list(languages), list(letters), list(texts))


def identify(docs: DataFrame, model: Model, *more: Column) -> DataFrame:
    """``doc_id, lang_pred, score`` of each row of ``docs``, and ``more``; reads nothing but the text.

    ``score`` is the share of the runner-up's pieces that the winner saves, 0 to
    1. Null texts and texts without a letter are ``und`` with score 0.
    """
    spec = spec_of(model)
    held = docs.sparkSession.sparkContext.broadcast(spec)

    def batches(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        built = _built(*held.value)
        for part in parts:
            names, scores = built.predict(part["text"].to_pylist())
            yield pa.record_batch([part["doc_id"], pa.array(names, pa.string()), pa.array(scores, pa.float64())],
                                  ["doc_id", "lang_pred", "score"])

    found = doc_rows(docs).mapInArrow(batches, "doc_id bigint, lang_pred string, score double")
    return found.select("doc_id", *more, "lang_pred", "score")


def spec_of(model: Model) -> tuple:
    return tuple(model.languages), tuple(model.letters), tuple(model.texts)
