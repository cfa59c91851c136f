"""Ranked lexical search by two trees, one over the items and one over documents.

An item is a vector of term weights, a document one of term impacts, and a score
is their inner product, in whole numbers. Each node of a tree holds the largest
value of each coordinate below it. The product of an item node and a document node
is then a bound of all scores between them: if it lies under the weakest k-th score
of the node's items, all these pairs are left out at once, without loss.

Texts are read once, to count the terms that items have; these sparse vectors are
staged. Workers then build trees over batches of documents of bounded size and
search them. They begin with the k-th scores among a sixteenth of the documents,
which bound those among all from below, so few rows leave a worker. Items are taken
in blocks of bounded size, one search for each.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tasteloom.llm.common import doc_rows, text_or_empty, write_stage
from tasteloom.schema import assert_columns

K1_PARTS, LENGTH_SHARE = 20, 50     # saturation and length rule of the score, see ``impacts``
_ITEM_LEAF, _DOC_LEAF = 4, 16
_ITEMS, _CELLS = 1024, 1 << 22      # of a block of items: rows, and rows times terms
_DOC_CELLS = 1 << 23                # of a tree of documents: rows times terms
_SEED = 16                          # one in so many documents gives the first bounds
_PIECE = 1 << 20
_LAST = 2**63 - 1
_TABLE = bytes(b if b >= 128 or 48 <= b <= 57 or 97 <= b <= 122 else b + 32 if 65 <= b <= 90 else 32 for b in range(256))


def terms(text: str) -> Iterator[list[bytes]]:
    """Runs of ASCII letters, digits and all that is not ASCII, A-Z in lower case; long texts in pieces."""
    raw = text.encode("utf-8", "surrogatepass").translate(_TABLE)
    at = 0
    while at < len(raw):
        end = raw.find(b" ", at + _PIECE)
        end = len(raw) if end < 0 else end
        yield raw[at:end].split()
        at = end


def impacts(tf: np.ndarray, n: np.ndarray, docs: int, length: int) -> np.ndarray:
    """The part of a document in its score for one term, by occurrences ``tf`` and number of terms ``n``."""
    m = 100 - LENGTH_SHARE + (LENGTH_SHARE * n * docs) // max(1, length)
    return (1_000_000_000 * tf) // (1000 * tf + K1_PARTS * m)


def weight(docs: int, df: int) -> int:
    return math.floor(1000 * math.log((2 * docs + 2) / (2 * df + 1)))


class Tree:
    """Rows parted at the median of their most uneven coordinate; ``maxima`` has a row for each node."""

    def __init__(self, rows: np.ndarray, leaf: int):
        order, self.nodes, stack = np.arange(len(rows)), [[0, len(rows), -1, -1]], [0]
        while stack:
            at = stack.pop()
            low, high = self.nodes[at][:2]
            if high - low <= leaf:
                continue
            own = rows[order[low:high]]
            by = own[:, int(own.std(axis=0).argmax())]
            order[low:high] = order[low:high][np.argsort(by, kind="stable")]
            middle = (low + high) // 2
            for k, part in ((2, (low, middle)), (3, (middle, high))):
                self.nodes[at][k] = len(self.nodes)
                stack.append(len(self.nodes))
                self.nodes.append([*part, -1, -1])
        self.order, sorted_rows = order, rows[order]
        self.maxima = np.zeros((len(self.nodes), rows.shape[1]), dtype=rows.dtype)
        for at in range(len(self.nodes) - 1, -1, -1):   # children stand behind their parent
            low, high, a, b = self.nodes[at]
            self.maxima[at] = np.maximum(self.maxima[a], self.maxima[b]) if a >= 0 else sorted_rows[low:high].max(axis=0)


class Best:
    """The ``k`` best (score, document) of each item so far, equal scores by the smaller document."""

    def __init__(self, least: np.ndarray, k: int):
        self.k, self.least = k, least.copy()
        self.scores = [np.zeros(0, dtype=np.int64) for _ in least]
        self.docs = [np.zeros(0, dtype=np.int64) for _ in least]

    def add(self, item: int, scores: np.ndarray, docs: np.ndarray) -> None:
        good = (scores >= self.least[item]) & (scores > 0)
        if not good.any():
            return
        scores, docs = np.append(self.scores[item], scores[good]), np.append(self.docs[item], docs[good])
        order = np.lexsort((docs, -scores))[: self.k]
        self.scores[item], self.docs[item] = scores[order], docs[order]
        if len(order) == self.k:
            self.least[item] = max(self.least[item], self.scores[item][-1])


def dual_search(items: np.ndarray, tree: Tree, rows: np.ndarray, docs: np.ndarray, best: Best) -> int:
    """Add to ``best`` what ``rows`` (with ids ``docs``) give for ``items``, rows in the order of their ``tree``.

    Returns the number of scores computed.
    """
    below = Tree(rows, _DOC_LEAF)
    rows, docs = rows[below.order], docs[below.order]
    bounds = tree.maxima @ below.maxima.T
    stack, scored = [(0, 0)], 0
    while stack:
        i, d = stack.pop()
        low, high, a, b = tree.nodes[i]
        first, last, c, e = below.nodes[d]
        if bounds[i, d] <= 0 or bounds[i, d] < best.least[low:high].min():
            continue
        if a < 0 and c < 0:
            used = np.flatnonzero(tree.maxima[i])
            scores = (items[low:high][:, used] @ rows[first:last][:, used].T).astype(np.int64)
            scored += scores.size
            for k in range(low, high):
                best.add(k, scores[k - low], docs[first:last])
            continue
        pairs = [(x, y) for x in ((a, b) if a >= 0 else (i,)) for y in ((c, e) if c >= 0 else (d,))]
        stack += sorted(pairs, key=lambda p: bounds[p])     # the most promising pair is taken first
    return scored


def _vectors(docs: DataFrame, words: list[bytes]) -> DataFrame:
    """``doc, n, ids, tfs``: the number of terms of each document and which of ``words`` it has how often."""
    def counted(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = {w: i for i, w in enumerate(words)}
        for part in parts:
            sizes, ids, tfs = [], [], []
            for text in part["text"].to_pylist():
                own: Counter = Counter()
                for piece in terms(text):
                    own.update(piece)
                sizes.append(own.total())
                hits = {known[w]: tf for w, tf in own.items() if w in known}
                ids.append(list(hits))
                tfs.append(list(hits.values()))
            yield pa.record_batch([part["doc"], pa.array(sizes, pa.int64()), pa.array(ids, pa.list_(pa.int32())),
                                   pa.array(tfs, pa.list_(pa.int64()))], ["doc", "n", "ids", "tfs"])

    rows = docs.select(F.coalesce("doc_id", F.lit(_LAST)).alias("doc"), text_or_empty().alias("text"))
    made = rows.mapInArrow(counted, "doc bigint, n bigint, ids array<int>, tfs array<bigint>")
    return write_stage(made.filter("n > 0"), "term-vectors")


def _searcher(items: np.ndarray, tree: Tree, least: np.ndarray, k: int, docs: int, length: int):
    """Best rows of a worker's documents, searched in batches that bound its memory."""
    width = items.shape[1]
    most = max(1, _DOC_CELLS // max(1, width))

    def search(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best = Best(least, k)
        for part in parts:
            for at in range(0, len(part), most):
                some = part.slice(at, most)
                sizes = some["n"].to_numpy()
                counts = np.diff(some["ids"].offsets.to_numpy())
                row = np.repeat(np.arange(len(some)), counts)
                rows = np.zeros((len(some), width), dtype=items.dtype)
                rows[row, some["ids"].flatten().to_numpy()] = impacts(
                    some["tfs"].flatten().to_numpy(), sizes[row], docs, length)
                dual_search(items, tree, rows, some["doc"].to_numpy(), best)
        for item, (scores, found) in enumerate(zip(best.scores, best.docs)):
            if len(scores):
                yield pa.record_batch([np.full(len(scores), tree.order[item]), found, scores], ["item", "doc", "score"])

    return search


def _blocks(staged: DataFrame) -> Iterator[list]:
    """Rows of items, as many as a search takes at once."""
    block, seen = [], set()
    for row in staged.toLocalIterator():
        more = seen.union(row["terms"])
        if block and (len(block) == _ITEMS or (len(block) + 1) * len(more) > _CELLS):
            yield block
            block, more = [], set(row["terms"])
        block.append(row)
        seen = more
    if block:
        yield block


def _search_block(docs: DataFrame, block: list, k: int) -> DataFrame:
    words = sorted({t for row in block for t in row["terms"]})
    vectors = _vectors(docs, words)
    count, length = vectors.agg(F.count("*"), F.coalesce(F.sum("n"), F.lit(0))).first()
    held = vectors.select(F.explode("ids").alias("id")).groupBy("id").count().collect()     # a number for each of ``words``
    weights = np.zeros(len(words), dtype=np.int64)
    for row in held:
        weights[row["id"]] = weight(count, row["count"])
    place = {w: i for i, w in enumerate(words)}
    exact = max((len(r["terms"]) for r in block), default=0) * int(weights.max(initial=0)) * 1_000_000 < 2**53
    items = np.zeros((len(block), len(words)), dtype=np.float64 if exact else np.int64)    # floats add such numbers exactly
    for i, row in enumerate(block):
        at = [place[t] for t in row["terms"]]
        items[i, at] = weights[at]
    tree = Tree(items, _ITEM_LEAF)
    items = items[tree.order]

    def search(of: DataFrame, least: np.ndarray) -> DataFrame:
        return of.mapInArrow(_searcher(items, tree, least, k, count, length), "item bigint, doc bigint, score bigint")

    order = Window.partitionBy("item").orderBy(F.desc("score"), "doc")
    first = search(vectors.filter(F.pmod(F.xxhash64("doc", "n"), F.lit(_SEED)) == 0), np.ones(len(block), dtype=np.int64))
    kth = first.withColumn("place", F.row_number().over(order)).filter(F.col("place") == k)
    least = np.ones(len(block), dtype=np.int64)
    for row in kth.select("item", "score").collect():       # one number for each item of the block at most
        least[row["item"]] = row["score"]
    found = search(vectors, least[tree.order]).withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
    names = docs.sparkSession.createDataFrame([(i, row["item_no"]) for i, row in enumerate(block)], "item bigint, item_no bigint")
    return found.join(names, "item").select("item_no", "rank", F.when(F.col("doc") != _LAST, F.col("doc")).alias("doc_id"), "score")


def search(docs: DataFrame, items: DataFrame, k: int = 50) -> DataFrame:
    """The ``k`` highest-scoring rows of ``docs`` for each row of ``items``: ``item_id, rank, doc_id, score``.

    Terms are runs of ASCII letters and digits and of all that is not ASCII, with
    A-Z in lower case. ``N`` is the number of documents with a term, ``L`` that of
    all their terms, ``n`` that of one document's, ``df`` the number of documents
    that hold a term, ``tf`` its number in one. A term weighs ``w = floor(1000 *
    ln((2N + 2) / (2df + 1)))``; a score sums ``w * (10^9 tf div (1000 tf + 20m))``
    over an item's distinct terms with ``m = 50 + 50nN div L``, in whole numbers.
    Rows have a score above 0; equal scores stand by ascending ``doc_id``, a null id
    last, and ``rank`` counts from 1 without repeats.

    Null and empty texts have no terms: such documents count nowhere and such items
    have no rows. Items that repeat an id and rows that repeat a document are
    rows like any other. Empty tables give no rows. Columns other than the id and
    ``text`` are ignored.
    """
    assert_columns(items, "item_id", "text")
    rows = items.select(F.monotonically_increasing_id().alias("item_no"), items["item_id"].alias("item_id"),
                        F.coalesce(items["text"].cast("string"), F.lit("")).alias("text"))
    kind = rows.schema["item_id"].dataType.simpleString()

    def parted(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            own = [sorted({t for piece in terms(text) for t in piece}) for text in part["text"].to_pylist()]
            yield pa.record_batch([part["item_no"], part["item_id"], pa.array(own, pa.list_(pa.binary()))],
                                  ["item_no", "item_id", "terms"])

    staged = write_stage(rows.mapInArrow(parted, f"item_no bigint, item_id {kind}, terms array<binary>"), "items")
    known = doc_rows(docs)
    found = None
    for block in _blocks(staged.filter("size(terms) > 0").select("item_no", "terms")):
        part = write_stage(_search_block(known, [{"item_no": r["item_no"], "terms": [bytes(t) for t in r["terms"]]} for r in block], k),
                           "ranked")
        found = part if found is None else found.unionByName(part)
    if found is None:
        return staged.limit(0).select("item_id", F.lit(0).alias("rank"), F.lit(0).cast("bigint").alias("doc_id"),
                                      F.lit(0).cast("bigint").alias("score"))
    return found.join(staged.select("item_no", "item_id"), "item_no").select("item_id", "rank", "doc_id", "score")
