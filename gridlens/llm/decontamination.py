"""Benchmark decontamination by latent semantic retrieval, then word-order checks.

Items and passages of documents are weighted by TF-IDF with document frequencies counted over the whole corpus.
A randomised SVD of the items and of all passages of the corpus that consist largely of the benchmark's terms (its
products with the passage matrix are summed over Spark tasks) gives the latent axes of the benchmark's terms.
An item's rarest words file it; around such a word, the latent inner product of the passage and the item, plus
what their parts beyond the axes can add at most, must reach the least that any stretch accepted by the word comparison
has (``Retrieval``).  Only what is retrieved goes on: first to the exact share of the item's words around
(``Screen``; neither loses a pair that would be accepted), then to the comparison in order: the longest common subsequence,
weighted by IDF, must hold most of the item, or enough of it together with its answer, the item's last words.
The best latent cosine of the passages around is reported with each pair found.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridlens.llm import kernels as K
from gridlens.llm.common import staged

RANK, OVERSAMPLE, POWER_ROUNDS, TERM_BITS = 256, 16, 2, 18
#: Words of the passages whose best cosine is reported, and the least share of their length that the benchmark's terms make.
SCALES = {64: 0.0, 24: 0.0}
#: The same for passages that the axes are fitted on, and for items.
FIT_SCALES, ITEM_SCALES = {64: 0.6}, {64: 0.0}
ITEMS_AT_ONCE, FIT_ROWS, PASSAGES_AT_ONCE, SCAN_BYTES, SCREEN_WORDS, PAIRS_AT_ONCE = 8192, 20_000, 256, 1 << 18, 1 << 20, 1 << 14
MOST_WORDS, PART_WORDS, ANSWER_SHARE, ANSWER_WORDS = 0.8, 0.55, 0.8, 6


def _item_words(texts: list[str]) -> list[np.ndarray]:
    data = [(t or "").encode("utf-8", "replace") for t in texts]
    offsets = np.cumsum([0, *map(len, data)])
    _, _, hashes, first = K.words(np.frombuffer(b"".join(data), dtype=np.uint8), offsets, K.MARKS)
    return [hashes[a:b] for a, b in zip(first[:-1], first[1:], strict=True)]


class Vocabulary:
    """Dense numbers for the benchmark's terms, found through a table of 2^20 slots."""

    BITS = 20

    def __init__(self, terms: np.ndarray):
        self.terms = np.unique(terms)
        slots = (self.terms >> np.uint64(64 - self.BITS)).astype(np.int64)
        self.start = np.searchsorted(slots, np.arange((1 << self.BITS) + 1)).astype(np.int32)
        self.deep = int(np.diff(self.start).max(initial=0))

    def numbers(self, hashes: np.ndarray) -> np.ndarray:
        """Each hash's number, or -1."""
        out = np.full(len(hashes), -1, dtype=np.int32)
        slot = (hashes >> np.uint64(64 - self.BITS)).astype(np.int64)
        at, end = self.start[slot], self.start[slot + 1]
        for _ in range(self.deep):
            open_ = np.flatnonzero((out < 0) & (at < end))
            if not len(open_):
                break
            hit = open_[self.terms[at[open_]] == hashes[open_]]
            out[hit] = at[hit]
            at[open_] += 1
        return out


def _passages(first: np.ndarray, scales) -> tuple[np.ndarray, ...]:
    """(row, first word, end word, least cosine) of all passages of a block's rows; scales: {words: least cosine}."""
    n_words, out = np.diff(first), []
    for window in scales:
        stride = window // 2
        n = np.where(n_words > 0, np.maximum(1, -(-(n_words - window) // stride) + 1), 0)
        row = np.repeat(np.arange(len(n)), n)
        nth = np.arange(len(row)) - np.repeat(np.cumsum(n) - n, n)
        start = first[row] + nth * stride
        out.append((row, start, np.minimum(start + window, first[row + 1]), np.full(len(row), scales[window])))
    return tuple(np.concatenate(x) for x in zip(*out, strict=True))


def _bucket(hashes: np.ndarray) -> np.ndarray:
    return (hashes >> np.uint64(64 - TERM_BITS)).astype(np.int64)


def _frequencies(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(bucket, documents that hold it) sums of a partition; bucket -1 counts the documents."""
    total, n = np.zeros(1 << TERM_BITS, dtype=np.int64), 0
    for batch in batches:
        n += batch.num_rows
        for _, _, data, offsets in K.blocks(K.utf8_column(batch.column("text"))):
            _, _, hashes, first = K.words(data, offsets, K.MARKS)
            owner = np.repeat(np.arange(len(first) - 1), np.diff(first))
            pairs = np.unique(owner << TERM_BITS | _bucket(hashes))
            total += np.bincount(pairs & (1 << TERM_BITS) - 1, minlength=len(total))
    used = np.flatnonzero(total)
    yield pa.RecordBatch.from_arrays([pa.array(np.append(used, -1)), pa.array(np.append(total[used], n))],
                                     names=["bucket", "n"])


class Space:
    """The benchmark's terms, the IDF of all hashed terms, and (once found) the latent axes."""

    def __init__(self, terms: np.ndarray, idf: np.ndarray):
        self.vocabulary, self.idf = Vocabulary(terms), idf
        self.term_idf = idf[_bucket(self.vocabulary.terms)]
        self.axes = np.zeros((len(self.vocabulary.terms), 0), dtype=np.float32)

    def known_passages(self, hashes: np.ndarray, first: np.ndarray, scales: dict[int, float],
                       around: np.ndarray | None = None):
        """Passages (that hold one of the places ``around``, if given) of which the benchmark's terms make at least the scale's share of the TF-IDF length.

        With weights sqrt(tf) * idf^2 a squared length is a sum over words, so two running sums
        give both lengths of every passage.  Returns (row, start, end, length) and, in
        passage order, (passage, term, weight relative to the passage's length).
        """
        row, start, end, least = _passages(first, scales)
        if around is not None:
            some = np.searchsorted(around, start) < np.searchsorted(around, end)
            row, start, end, least = row[some], start[some], end[some], least[some]
        number = self.vocabulary.numbers(hashes)
        square = self.idf[_bucket(hashes)].astype(np.float64) ** 2
        whole = np.append(0.0, np.cumsum(square))
        ours = np.append(0.0, np.cumsum(np.where(number >= 0, square, 0.0)))
        length = np.sqrt(np.maximum(whole[end] - whole[start], 1e-12))
        keep = np.sqrt(np.maximum(ours[end] - ours[start], 0.0)) >= np.maximum(least * length, 1e-9)
        row, start, end, least, length = row[keep], start[keep], end[keep], least[keep], length[keep]
        at = np.flatnonzero(number >= 0)
        lo, hi = np.searchsorted(at, start), np.searchsorted(at, end)
        size = hi - lo
        passage = np.repeat(np.arange(len(start)), size)
        place = np.arange(len(passage)) - np.repeat(np.cumsum(size) - size, size) + np.repeat(lo, size)
        wide = np.int64(len(self.term_idf) + 1)
        pairs, count = np.unique(passage * wide + number[at[place]], return_counts=True)
        passage, term = pairs // wide, pairs % wide
        return (row, start, end, length), (passage, term, np.sqrt(count) * self.term_idf[term] / length[passage])

    def project(self, passage, term, weight, n: int) -> np.ndarray:
        """Latent vectors: rows of (passage matrix) x axes."""
        out = np.zeros((n, self.axes.shape[1]), dtype=np.float32)
        weight = weight.astype(np.float32)
        edges = np.append(np.flatnonzero(np.append(True, passage[1:] != passage[:-1])), len(passage)).tolist() if len(passage) else []
        for lo, hi in zip(edges[:-1], edges[1:], strict=True):  # a small product each is faster than one sum by groups
            out[passage[lo]] = weight[lo:hi] @ self.axes[term[lo:hi]]
        return out


def _fit_passages(shared):
    """The passages that the axes are fitted on, as sparse rows of the passage matrix."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        space = shared.value
        for batch in batches:
            for _, _, data, offsets in K.blocks(K.utf8_column(batch.column("text")), SCAN_BYTES):
                _, _, hashes, first = K.words(data, offsets, K.MARKS)
                (row, *_), (passage, term, weight) = space.known_passages(hashes, first, FIT_SCALES)
                edges = pa.array(np.searchsorted(passage, np.arange(len(row) + 1)), pa.int32())
                yield pa.RecordBatch.from_arrays(
                    [pa.ListArray.from_arrays(edges, x) for x in (pa.array(term, pa.int32()), pa.array(weight, pa.float32()))],
                    names=["terms", "weights"])
    return run


def _product(shared):
    """A task's share of (passage matrix)' (passage matrix) x axes, one row per term."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        space = shared.value
        total = np.zeros(space.axes.shape)
        for batch in batches:
            for at in range(0, batch.num_rows, PASSAGES_AT_ONCE):
                part = batch.slice(at, PASSAGES_AT_ONCE)
                size = part.column("terms").value_lengths().to_numpy()
                passage = np.repeat(np.arange(len(size)), size)
                term, weight = (part.column(c).flatten().to_numpy() for c in ("terms", "weights"))
                rows = space.project(passage, term, weight, len(size))
                order = np.argsort(term, kind="stable")
                if len(order):
                    heads = np.flatnonzero(np.append(True, np.diff(term[order]) > 0))
                    total[term[order][heads]] += np.add.reduceat(rows[passage[order]] * weight[order][:, None], heads, axis=0)
        used = np.flatnonzero(np.abs(total).sum(axis=1))
        yield pa.RecordBatch.from_arrays([pa.array(used), pa.array(list(total[used]), pa.list_(pa.float64()))],
                                         names=["term", "sums"])
    return run


def _add_up(table: pa.Table) -> pa.Table:
    term, where = np.unique(table.column("term").to_numpy(), return_inverse=True)
    sums = table.column("sums").combine_chunks().flatten().to_numpy().reshape(len(where), -1)
    out = np.zeros((len(term), sums.shape[1]))
    np.add.at(out, where, sums)
    return pa.table({"term": pa.array(term), "sums": pa.array(list(out), pa.list_(pa.float64()))})


def latent_axes(texts: DataFrame, space: Space, rank: int = RANK) -> np.ndarray:
    """The leading right singular vectors of the TF-IDF passages of all ``texts``, terms x rank.

    One scan of the texts stages the rows of the passage matrix.  Each power round multiplies a thin random matrix
    by it and its transpose: tasks of ``FIT_ROWS`` passages or more do their share, Spark adds the shares up per term, and
    the driver only orthogonalises the thin result, whose size the benchmark's vocabulary fixes.
    """
    spark = texts.sparkSession
    size = len(space.term_idf)
    matrix = staged(texts.mapInArrow(_fit_passages(spark.sparkContext.broadcast(space)),
                                     "terms array<int>, weights array<float>"), "passages")
    matrix = matrix.repartition(max(1, matrix.count() // FIT_ROWS))
    width = min(size, rank + OVERSAMPLE)
    space.axes = np.linalg.qr(np.random.default_rng(3).standard_normal((size, width)))[0].astype(np.float32)
    for _ in range(POWER_ROUNDS):
        sums = matrix.mapInArrow(_product(spark.sparkContext.broadcast(space)), "term long, sums array<double>")
        sums = sums.groupBy(F.expr("pmod(term, 16)")).applyInArrow(_add_up, "term long, sums array<double>")
        thin = np.random.default_rng(4).standard_normal((size, width)) * 1e-9
        for batch in sums.toArrow().to_batches():
            thin[batch.column("term").to_numpy()] += np.array(batch.column("sums").to_pylist()).reshape(-1, width)
        q, r = np.linalg.qr(thin)
        space.axes = (q @ np.linalg.svd(r)[0]).astype(np.float32)
    return space.axes[:, :rank]


class Retrieval:
    """Which filed places a passage around may hold the item at, by latent inner products.

    An accepted stretch shares words with the item that weigh ``PART_WORDS`` of it, so its inner product with the item (the
    square root of both counts times the squared weight, summed over terms) is at least that of the item's lightest
    words of this weight, ``need``.  It lies whole in a passage of twice ``_reach`` words or more, whose inner product is no
    smaller.  That is the latent one plus one of the parts beyond the axes, which their lengths bound.  So nothing
    that would be accepted is left out, whatever the axes; good axes leave out more.
    """

    #: Share of both lengths by which single precision may err.
    SLACK = 1e-4

    def __init__(self, space: Space, items: list[np.ndarray]):
        counted = [np.unique(space.vocabulary.numbers(w), return_counts=True) for w in items]
        owner = np.repeat(np.arange(len(items)), [len(term) for term, _ in counted])
        term, count = (np.concatenate(x) for x in zip(*counted, strict=True))
        weight = np.sqrt(count) * space.term_idf[term].astype(np.float64)
        self.vectors = space.project(owner, term, weight, len(items))
        square = np.bincount(owner, weights=weight ** 2, minlength=len(items))
        self.length = np.sqrt(square)
        self.rest = np.sqrt(np.maximum(square - (self.vectors.astype(np.float64) ** 2).sum(axis=1), 0.0))
        self.need = np.array([self._need(space.term_idf[t].astype(np.float64), c) for t, c in counted])
        self.words = np.array([1 << (_reach(len(w)) - 1).bit_length() for w in items], dtype=np.int64)

    def _need(self, idf: np.ndarray, count: np.ndarray) -> float:
        light = np.argsort(idf, kind="stable")
        idf, weight = idf[light], (count * idf)[light]
        before = np.cumsum(weight) - weight
        taken = np.clip(PART_WORDS * weight.sum() * (1 - self.SLACK) - before, 0.0, weight)
        return float((taken * idf).sum())

    def near(self, space: Space, hashes: np.ndarray, first: np.ndarray, item: np.ndarray, place: np.ndarray) -> np.ndarray:
        """Whether each place is in a passage that may hold the item."""
        keep = np.zeros(len(place), dtype=bool)
        for words in np.unique(self.words[item]):
            mine = np.flatnonzero(self.words[item] == words)
            (_, start, end, length), (passage, term, weight) = space.known_passages(
                hashes, first, {2 * int(words): 0.0}, around=np.unique(place[mine]))
            weight = weight * length[passage]
            latent = space.project(passage, term, weight, len(start))
            square = np.bincount(passage, weights=weight ** 2, minlength=len(start))
            rest = np.sqrt(np.maximum(square - (latent.astype(np.float64) ** 2).sum(axis=1), 0.0))
            lo, hi = np.searchsorted(end, place[mine], side="right"), np.searchsorted(start, place[mine], side="right")
            size = hi - lo
            pair = np.repeat(np.arange(len(mine)), size)
            around = np.arange(len(pair)) - np.repeat(np.cumsum(size) - size, size) + np.repeat(lo, size)
            codes, which = np.unique(item[mine][pair] * np.int64(len(start)) + around, return_inverse=True)
            may = np.zeros(len(codes), dtype=bool)
            for a in range(0, len(codes), PAIRS_AT_ONCE):
                i, p = np.divmod(codes[a:a + PAIRS_AT_ONCE], len(start))
                most = (np.einsum("ij,ij->i", self.vectors[i], latent[p]) + self.rest[i] * rest[p]
                        + self.SLACK * self.length[i] * np.sqrt(square[p]))
                may[a:a + PAIRS_AT_ONCE] = most >= self.need[i]
            keep[mine[pair[may[which]]]] = True
        return keep


class Screen:
    """Where a document holds enough of an item's words for the word comparison to accept it.

    The comparison needs ``PART_WORDS`` of an item's weight within ``_reach`` words.  So one of its
    rarest terms must be there, as many of which are filed as make all others weigh less than that,
    and the item's terms around it must weigh enough.  Both only overestimate the ordered
    share: no pair that the comparison would accept is lost.
    """

    def __init__(self, space: Space, items: list[np.ndarray]):
        self.n_terms = np.int64(max(1, len(space.term_idf)))
        self.numbers = [space.vocabulary.numbers(w) for w in items]
        self.reach = np.array([_reach(len(w)) for w in items], dtype=np.int64)
        codes, weights, key_terms, key_items = [], [], [], []
        self.least = np.zeros(len(items))
        for i, numbers in enumerate(self.numbers):
            term, count = np.unique(numbers, return_counts=True)
            weight = count * space.term_idf[term].astype(np.float64)
            self.least[i] = PART_WORDS * weight.sum() * (1 - 1e-6)
            codes.append(i * self.n_terms + term)
            weights.append(weight)
            rarest = np.argsort(-space.term_idf[term], kind="stable")
            rest = weight.sum() - np.cumsum(weight[rarest])
            keys = term[rarest[:int(np.argmax(rest < self.least[i])) + 1]]
            key_terms.append(keys)
            key_items.append(np.full(len(keys), i))
        self.codes, self.weights = np.concatenate(codes), np.concatenate(weights)
        term, item = np.concatenate(key_terms), np.concatenate(key_items)
        order = np.argsort(term, kind="stable")
        self.key_items = item[order]
        self.key_start = np.searchsorted(term[order], np.arange(self.n_terms + 1))

    def filed(self, numbers: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(item, place of a term that it is filed under); numbers: a block's terms, or -1."""
        at = np.flatnonzero(numbers >= 0)
        size = self.key_start[numbers[at] + 1] - self.key_start[numbers[at]]
        place, start = np.repeat(at, size), np.repeat(self.key_start[numbers[at]], size)
        return self.key_items[start + np.arange(len(place)) - np.repeat(np.cumsum(size) - size, size)], place

    def places(self, numbers: np.ndarray, first: np.ndarray, item: np.ndarray, place: np.ndarray) -> tuple[
            np.ndarray, np.ndarray, np.ndarray]:
        """(row, item, place) of the filed places around which enough of the item's weight is found."""
        at = np.flatnonzero(numbers >= 0)
        row = np.searchsorted(first, place, side="right") - 1
        lo = np.searchsorted(at, np.maximum(first[row], place - self.reach[item]))
        hi = np.searchsorted(at, np.minimum(first[row + 1], place + self.reach[item] + 1))
        keep, done = np.zeros(len(place), dtype=bool), np.append(0, np.cumsum(hi - lo))
        a = 0
        while a < len(place):  # in parts of a bounded number of words
            b = max(a + 1, int(np.searchsorted(done, done[a] + SCREEN_WORDS, side="right")) - 1)
            hit = np.repeat(np.arange(b - a), hi[a:b] - lo[a:b])
            word = np.arange(done[b] - done[a]) - (done[a:b] - done[a] - lo[a:b])[hit]
            code = item[a:b][hit] * self.n_terms + numbers[at[word]]
            found = np.minimum(np.searchsorted(self.codes, code), len(self.codes) - 1)
            ours = self.codes[found] == code
            once = np.unique(hit[ours] * np.int64(len(self.codes)) + found[ours])
            held = np.bincount(once // len(self.codes), weights=self.weights[once % len(self.codes)], minlength=b - a)
            keep[a:b] = held >= self.least[item[a:b]]
            a = b
        return row[keep], item[keep], place[keep]


def _reach(n: int) -> int:
    """Words of a document over which an item of ``n`` words may be spread."""
    return 2 * n + 8


_BEGIN_BITS = 20


def ordered_shares(item: np.ndarray, weight: np.ndarray, windows: np.ndarray, answer: int) -> list[tuple[float, float, int, int]]:
    """For each row of ``windows``, its weighted longest common subsequence with an item: its share, the share of
    the last ``answer`` words in it, and where its shortest such stretch begins and ends.

    A cell holds the weight and, below it, the begin of the best sequence, so of equal weights the latest begin wins.
    """
    n, (many, m) = len(item), windows.shape
    whole = np.maximum(1, np.round(weight * (1 << 16))).astype(np.int64)
    table = np.zeros((n + 1, many, m + 1), dtype=np.int64)
    for i in range(n):
        step = table[i, :, :-1]
        grown = np.where(step >> _BEGIN_BITS, step, np.arange(m)) + (whole[i] << _BEGIN_BITS)
        table[i + 1, :, 1:] = np.maximum.accumulate(np.maximum(table[i, :, 1:], np.where(windows == item[i], grown, 0)), axis=1)
    out = []
    for w in range(many):
        total = table[n, w, m]
        if (total >> _BEGIN_BITS) < PART_WORDS * whole.sum():
            continue
        i, j, tail = n, int(np.searchsorted(table[n, w], total)), 0
        end, begin = j, int(total & (1 << _BEGIN_BITS) - 1)
        while i and j and table[i, w, j] >> _BEGIN_BITS:
            if table[i, w, j] == table[i - 1, w, j]:
                i -= 1
            elif table[i, w, j] == table[i, w, j - 1]:
                j -= 1
            else:
                i, j = i - 1, j - 1
                tail += whole[i] if i >= n - answer else 0
        out.append(((total >> _BEGIN_BITS) / whole.sum(), tail / whole[n - answer:].sum(), w, begin, end))
    return out


def _spot(item: np.ndarray, weight: np.ndarray, ours: np.ndarray, hashes: np.ndarray, places: np.ndarray,
          first: int, end: int) -> tuple[float, float, int, int] | None:
    """The best stretch around ``places`` that holds the item: (share, answer's share, first word, end word).

    Every stretch of ``_reach`` words that starts with a word of the item and reaches one of the places is
    compared by itself, so a long loose match cannot hide a short one.
    """
    reach, answer = _reach(len(item)), min(ANSWER_WORDS, len(item))
    starts = np.unique(np.concatenate([np.arange(max(first, p - reach + 1), p + 1) for p in places.tolist()]))
    starts = starts[ours[starts]]
    best = None
    for part in np.array_split(starts, -(-len(starts) * reach * len(item) // 2_000_000) or 1):
        at = part[:, None] + np.arange(reach)
        windows = np.where(at < end, hashes[np.minimum(at, end - 1)], np.uint64(0))
        for share, tail, w, a, b in ordered_shares(item, weight, windows, answer):
            if share >= MOST_WORDS or share >= PART_WORDS and tail >= ANSWER_SHARE:
                hit = (share, tail, int(part[w]) + a - first, int(part[w]) + b - first)
                best = max(best, hit) if best else hit
    return best


def _search(shared):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        space, retrieval, items, item_vectors, owners, names = shared.value
        weights = [space.term_idf[space.vocabulary.numbers(w)].astype(np.float64) for w in items]
        screen = Screen(space, items)
        vectors_of = np.searchsorted(owners, np.arange(len(items) + 1))
        for batch in batches:
            ids = batch.column("doc_id")
            for first_row, _, data, offsets in K.blocks(K.utf8_column(batch.column("text")), SCAN_BYTES):
                _, _, hashes, first = K.words(data, offsets, K.MARKS)
                numbers = space.vocabulary.numbers(hashes)
                item, place = screen.filed(numbers)
                near = retrieval.near(space, hashes, first, item, place)
                held_row, held_item, place = screen.places(numbers, first, item[near], place[near])
                order = np.lexsort((place, held_item, held_row))
                heads = np.flatnonzero(np.append(True, (np.diff(held_row[order]) != 0) | (np.diff(held_item[order]) != 0)))
                out = []
                for of in np.split(order, heads[1:]) if len(order) else ():
                    r, item = int(held_row[of[0]]), int(held_item[of[0]])
                    ours = np.isin(numbers[first[r]:first[r + 1]], screen.numbers[item])
                    found = _spot(items[item], weights[item], ours, hashes[first[r]:first[r + 1]], place[of] - first[r],
                                  0, int(first[r + 1] - first[r]))
                    if found:
                        (row, *_), known = space.known_passages(
                            hashes[first[r]:first[r + 1]], first[r:r + 2] - first[r], SCALES, around=place[of] - first[r])
                        score = (space.project(*known, len(row)) @ item_vectors[vectors_of[item]:vectors_of[item + 1]].T).max(initial=0.0)
                        out.append((first_row + r, names[item], float(score), *found))
                if out:
                    r, item, cosine, share, tail, begin, stop = zip(*out, strict=True)
                    yield pa.RecordBatch.from_arrays(
                        [ids.take(pa.array(r)), pa.array(item, pa.int64()), *(pa.array(x, pa.float64()) for x in (cosine, share, tail)),
                         pa.array(begin, pa.int64()), pa.array(stop, pa.int64())],
                        names=["doc_id", "item_id", "cosine", "lcs_share", "answer_share", "first_word", "end_word"])
    return run


_FOUND = ("doc_id long, item_id long, cosine double, lcs_share double, answer_share double, "
          "first_word long, end_word long")


def contaminated(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """(doc_id, item_id, cosine, lcs_share, answer_share, first_word, end_word): documents that hold an item.

    One row per document row and item found; word numbers count from the document's
    start.  ``docs`` has doc_id and text, ``benchmark`` item_id and text; other columns are not
    read.  Null, empty and wordless texts on either side match nothing; items that repeat
    are all reported; a null doc_id is reported as null.  The benchmark is taken
    about ``ITEMS_AT_ONCE`` items at a time, each in two passes over the documents (one for the axes, one
    that searches), so what is sent to tasks has a fixed bound.
    """
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    out = docs.where("false").selectExpr("doc_id", "0L item_id", "0D cosine", "0D lcs_share", "0D answer_share",
                                         "0L first_word", "0L end_word")
    for parts in _item_groups(docs, benchmark):
        out = out.union(docs.mapInArrow(_search(parts), _FOUND))
    return out


def _item_groups(docs: DataFrame, benchmark: DataFrame):
    """What the search needs of about ITEMS_AT_ONCE items at a time, as broadcasts."""
    spark = docs.sparkSession
    docs = docs.select("doc_id", F.col("text").cast("string").alias("text"))
    items = staged(benchmark.select(F.col("item_id").cast("long").alias("item_id"), F.col("text").cast("string").alias("text"))
                   .where("text is not null"), "items")
    groups = -(-items.count() // ITEMS_AT_ONCE)
    if not groups:
        return
    frequency, n_docs = np.zeros(1 << TERM_BITS), 0
    counts = docs.mapInArrow(_frequencies, "bucket long, n long").groupBy("bucket").agg(F.sum("n").alias("n")).toArrow()
    for bucket, n in zip(*(counts.column(c).to_pylist() for c in ("bucket", "n")), strict=True):
        if bucket < 0:
            n_docs = n
        else:
            frequency[bucket] = n
    # squared, so that a few rare shared words outweigh many common ones
    idf = (np.log1p(n_docs / (1.0 + frequency)) ** 2 + 0.01).astype(np.float32)
    texts = docs.select("text").union(items.select("text"))
    for g in range(groups):
        group = items.where(F.expr(f"pmod(xxhash64(item_id, text), {groups}) = {g}")).collect()
        words = [(r["item_id"], w) for r, w in zip(group, _item_words([r["text"] for r in group]), strict=True) if len(w)]
        if not words:
            continue
        space = Space(np.concatenate([w for _, w in words]), idf)
        space.axes = latent_axes(texts, space)
        vectors, owners = [], []
        for i, (_, w) in enumerate(words):
            (row, *_), known = space.known_passages(w, np.array([0, len(w)]), ITEM_SCALES)
            vectors.append(space.project(*known, len(row)))
            owners += [i] * len(row)
        vectors = np.concatenate(vectors)
        vectors /= np.maximum(np.linalg.norm(vectors, axis=1, keepdims=True), 1e-9)
        parts = spark.sparkContext.broadcast(
            (space, Retrieval(space, [w for _, w in words]), [w for _, w in words], vectors, owners, [n for n, _ in words]))
        yield parts


def _without(shared):
    """The rows of a batch in which the search finds nothing, as they are."""
    search = _search(shared)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        waiting: list[pa.RecordBatch] = []
        bad: set[int] = set()
        first = [0]

        def clean() -> Iterator[pa.RecordBatch]:
            while waiting:
                batch = waiting.pop(0)
                keep = np.array([i not in bad for i in range(first[0], first[0] + batch.num_rows)], dtype=bool)
                first[0] += batch.num_rows
                yield batch.filter(pa.array(keep))
            bad.clear()

        def numbered() -> Iterator[pa.RecordBatch]:
            n = 0
            for batch in batches:
                waiting.append(batch)
                yield pa.RecordBatch.from_arrays([pa.array(np.arange(n, n + batch.num_rows)), batch.column("text")],
                                                 names=["doc_id", "text"])
                n += batch.num_rows
                ready.extend(clean())  # the search is done with this batch when it asks for the next

        ready: list[pa.RecordBatch] = []
        for found in search(numbered()):
            yield from ready
            ready.clear()
            bad.update(found.column("doc_id").to_pylist())
        yield from ready
    return run


def without_items(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The rows of ``docs`` in which :func:`contaminated` finds no item, with all their columns.

    Rows are judged one by one, whatever their doc_id: null and repeated ids need no rule, and nothing is
    shuffled or joined.  The benchmark's groups of items follow each other in one pass over the rows."""
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    for parts in _item_groups(texts, benchmark):
        docs = docs.mapInArrow(_without(parts), docs.schema)
    return docs
