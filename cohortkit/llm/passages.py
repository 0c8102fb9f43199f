"""Repeated passages by collinear chaining.

1. Seeds: of every ``w`` consecutive word k-mers of a text the one with the least hash
   (a minimizer), so any two texts that share ``k + w - 1`` words share a seed.
2. Every occurrence of a seed is matched with its first one (least id and place), if that is in another
   document, and with the first one of its own document, if that is ``min_words`` earlier or more; in a run
   that repeats itself more often than that, with the last one so far before it.  So a seed with m
   occurrences makes less than 2 m matches, not m squared.
3. The matches of two texts are put together where they continue each other, and chained: the best
   chain that ends in a piece is its length plus the best earlier chain less a cost for the gaps on both
   sides, found by a tree of maxima over the pieces that are near enough.  A piece with none near enough is a chain.
4. Chains are aligned on the words of both texts, extended at both ends while matches outweigh
   differences, and kept as passages of ``min_words`` words or more with ``identity`` or more of them equal; a chain
   with fewer equal words is parted at its widest gaps.

5. Seeds that are in no accepted passage with another document are matched again: one of at most ``FEW`` places with
   every earlier document that has it; a more frequent one with the first place of it and its next shared
   seed together, and with that of as many shared seeds as span ``min_words``.  The latter
   are equal over ``min_words``, so their match is accepted; their number does not grow with the square of a seed's places.

A later occurrence of a passage is reported with the document that has it first; where an even earlier text
has only some of it, with that text for this part.  Not looked for: fuzzy passages all of whose seeds have more than
``FEW`` places, where neither the seeds, nor two neighbours, nor those of ``min_words`` have their first place in a text that has the passage.

Shuffles: seed hashes with a count; seeds that more than one place has; short match rows; texts only of documents in
chains (a fixed-size slot table keeps the others out).  A match group holds two documents' matches
and grows only with their length.

Defined cases: null and short texts have no passages; a row without an id is left out; repeated rows (same
id and text) are one document; of different texts with one id each is read, but their places cannot be told apart;
other columns are ignored.
"""

from __future__ import annotations

from bisect import bisect_left

import numpy as np
import pyarrow as pa
import pyarrow.compute
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import stored, text_slices
from .shingles import MIX, hashed_words, joined_words, shingle_hashes, signed, xxh_words

SLOTS = 1 << 20
#: Bytes of texts whose words are hashed at a time.
SLICE = 1 << 20
#: Pairs of pieces, or words beside chains, that are compared at a time.
AT_ONCE = 1 << 18
#: Places of a seed that are all compared where the first one leads to no passage.
FEW = 16
PLACE = ["id", "first_word", "stop_word", "match_id", "match_first_word", "match_stop_word"]


def minimizers(hashes: np.ndarray, k: int, w: int) -> tuple[np.ndarray, np.ndarray]:
    """(seed hashes, their word places) of a text's hashed words."""
    kmers = shingle_hashes(hashes, k)
    if len(hashes) < k + w - 1:
        at = np.array([int(kmers.argmin())]) if len(hashes) >= k else np.zeros(0, np.int64)
    else:
        at = np.unique(np.lib.stride_tricks.sliding_window_view(kmers, w).argmin(1) + np.arange(len(kmers) - w + 1))
    return kmers[at], at


def minimizers_of_texts(hashes: np.ndarray, bounds: np.ndarray, k: int, w: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(text, seed hash, word place) of the ``minimizers`` of many texts in one go, in order; text t has the words ``bounds[t]`` to ``bounds[t + 1]``."""
    n, kmers = np.diff(bounds), shingle_hashes(hashes, k)
    some = np.flatnonzero((n >= k) & (n < k + w - 1))
    short = [int(bounds[t] + kmers[bounds[t]:bounds[t] + n[t] - k + 1].argmin()) for t in some]
    m = max(0, len(hashes) - k - w + 2)  # windows, of which those within one text count
    best, least = kmers[:m].copy(), np.zeros(m, np.int64)
    for j in range(1, w):
        lower = kmers[j:j + m] < best
        np.copyto(best, kmers[j:j + m], where=lower)
        least[lower] = j
    text = np.repeat(np.arange(len(n)), n)[:m]
    found = (least + np.arange(m))[np.arange(m) + k + w - 1 <= bounds[1:][text]]
    found = found[np.r_[True, found[1:] != found[:-1]][:len(found)]]  # the places ascend with the windows
    found = np.sort(np.r_[found, np.array(short, np.int64)])
    text = np.searchsorted(bounds, found, "right") - 1
    return text, kmers[found], found - bounds[text]


def own_places(s: np.ndarray, at: np.ndarray, least: int, text: np.ndarray | int = 0) -> np.ndarray:
    """For each seed of a text the place in the same text it is matched with, or -1: the seed's first one if that is ``least`` words
    earlier; where the seed comes again within ``least`` words (a short period), the last one that is, so that the run stays on one diagonal.
    Seeds are in order of their ``text`` and place."""
    order = np.argsort(s, kind="stable")
    s, p, text = s[order], at[order].astype(np.int64), np.broadcast_to(text, len(s))[order]
    new = np.r_[True, (s[1:] != s[:-1]) | (text[1:] != text[:-1])][:len(s)]
    start = np.flatnonzero(new)[np.cumsum(new) - 1]
    key = np.cumsum(new) * (1 << 32) + p
    far = np.searchsorted(key, key - least, "right") - 1
    dense = ~new & (np.r_[0, np.diff(p)][:len(p)] < least)
    found = np.where(far >= start, np.where(dense, p[far], p[start]), -1)
    out = np.empty(len(s), np.int64)
    out[order] = found
    return out


class RangeMax:
    """Tree of maxima over n places: the best (value, tag) among places from p on; a place can be set again, or emptied."""

    NONE = (float("-inf"), -1)

    def __init__(self, n: int):
        self.n = n
        self.best = [self.NONE] * (2 * n)

    def put(self, p: int, item: tuple[float, int] = NONE) -> None:
        p += self.n
        self.best[p] = item
        while p > 1:
            p >>= 1
            self.best[p] = max(self.best[2 * p], self.best[2 * p + 1])

    def get(self, p: int) -> tuple[float, int]:
        lo, hi, out = p + self.n, 2 * self.n, self.NONE
        while lo < hi:
            if lo & 1:
                out = max(out, self.best[lo])
                lo += 1
            if hi & 1:
                hi -= 1
                out = max(out, self.best[hi])
            lo, hi = lo >> 1, hi >> 1
        return out


def pieces_of_pairs(pair: np.ndarray, x: np.ndarray, y: np.ndarray, k: int, reach: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Matches (x, y) of one pair of texts and on one diagonal within ``reach`` of each other, as arrays of (pair, x, y, length) in order."""
    order = np.lexsort((x, y - x, pair))
    pair, x, y = pair[order], x[order], y[order]
    new = np.r_[True, (np.diff(pair) != 0) | (np.diff(y - x) != 0) | (np.diff(x) > reach)][:len(x)]
    first = np.flatnonzero(new)
    last = np.r_[first[1:], len(x)][:len(first)] - 1
    pair, n, x, y = pair[first], x[last] + k - x[first], x[first], y[first]
    order = np.lexsort((y, x, pair))
    return pair[order], x[order], y[order], n[order]


def pieces(x: np.ndarray, y: np.ndarray, k: int, reach: int) -> list[tuple[int, int, int]]:
    """``pieces_of_pairs`` of the matches of one pair, as (x, y, length)."""
    _, *of = pieces_of_pairs(np.zeros(len(x), np.int64), x, y, k, reach)
    return list(zip(*(c.tolist() for c in of)))


def chains(parts: list[tuple[int, int, int]], gap: int) -> list[list[tuple[int, int, int]]]:
    """Pieces in chains that ascend in both texts, best chains first, each piece in one.

    A chain's worth is the words of its pieces less 1/(2 gap) of the words between their starts, on both
    sides, which parts into a term of each end, so maxima over the earlier pieces do.  Two pieces further than ``gap``
    apart are not chained: pieces that end too early in the first text leave the tree, and of the others those that
    end late enough in the second text are asked for.
    """
    if len(parts) == 1:
        return [parts]
    cost = 1 / (2 * gap)
    ends = sorted((y + n, t) for t, (_, y, n) in enumerate(parts))
    slot = [0] * len(parts)
    for p, (_, t) in enumerate(ends):
        slot[t] = p
    leaving = sorted(range(len(parts)), key=lambda t: parts[t][0] + parts[t][2])
    tree, worth, before, left = RangeMax(len(parts)), [0.0] * len(parts), [-1] * len(parts), 0
    i = 0
    while i < len(parts):
        x = parts[i][0]
        while parts[leaving[left]][0] + parts[leaving[left]][2] < x - gap:
            tree.put(slot[leaving[left]])
            left += 1
        j = i
        while j < len(parts) and parts[j][0] == x:  # pieces with one x cannot follow each other
            _, y, n = parts[j]
            aside = []  # pieces that end late enough but begin too late
            value, tag = tree.get(since := bisect_left(ends, (y - gap, -1)))
            while tag >= 0 and parts[tag][1] >= y:
                aside.append((slot[tag], (value, tag)))
                tree.put(slot[tag])
                value, tag = tree.get(since)
            for p, item in aside:
                tree.put(p, item)
            gained = value - cost * (x + y)
            worth[j] = n
            if tag >= 0 and gained > 0:
                worth[j], before[j] = n + gained, tag
            j += 1
        for t in range(i, j):
            tree.put(slot[t], (worth[t] + cost * (parts[t][0] + parts[t][1]), t))
        i = j
    out, used = [], [False] * len(parts)
    for t in sorted(range(len(parts)), key=lambda t: -worth[t]):
        chain = []
        while t >= 0 and not used[t]:
            used[t] = True
            chain.append(parts[t])
            t = before[t]
        if chain:
            out.append(chain[::-1])
    return out


def in_reach(pair: np.ndarray, x: np.ndarray, y: np.ndarray, n: np.ndarray, gap: int) -> np.ndarray:
    """Whether another piece of the same pair can come before or after a piece in a chain: one that begins earlier in both texts and ends at most
    ``gap`` before the later one begins.  The pieces are in order, as ``pieces_of_pairs`` has them.

    Pieces of about one length are searched at a time, so that only those that begin near enough for their length are compared."""
    out = np.zeros(len(x), bool)
    if not len(x):
        return out
    wide = int(x.max()) + int(n.max()) + 2 * gap + 2
    place = pair * wide + x
    size = np.frexp(n.astype(np.float64))[1]
    for z in np.unique(size):
        of = np.flatnonzero(size == z)
        since = np.searchsorted(place[of], pair * wide + np.maximum(0, x - gap - (1 << int(z))), "left")
        many = np.maximum(0, np.searchsorted(place[of], place, "left") - since)
        before = np.r_[0, np.cumsum(many)]
        i = 0
        while i < len(x):  # as many later pieces at a time as ``AT_ONCE`` comparisons do, or one
            j = max(i + 1, int(np.searchsorted(before, before[i] + AT_ONCE, "right")) - 1)
            later = np.repeat(np.arange(i, j), many[i:j])
            q = of[np.arange(len(later)) - np.repeat(before[i:j] - before[i] - since[i:j], many[i:j])]
            near = (y[q] < y[later]) & (x[q] + n[q] >= x[later] - gap) & (y[q] + n[q] >= y[later] - gap)
            out[q[near]] = out[later[near]] = True
            i = j
    return out


def chains_of_pairs(pair: np.ndarray, x: np.ndarray, y: np.ndarray, n: np.ndarray, gap: int) -> tuple[np.ndarray, list[tuple[int, list]]]:
    """``chains`` of the pieces of many pairs: (the pieces that none of their pair is ``in_reach`` of, which are a chain each, (pair, chain) of the others)."""
    near = in_reach(pair, x, y, n, gap)
    some = np.flatnonzero(near)
    starts = np.flatnonzero(np.r_[True, np.diff(pair[some]) != 0][:len(some)])
    out = []
    for part in np.split(some, starts[1:]) if len(some) else ():
        out += [(int(pair[part[0]]), c) for c in chains(list(zip(x[part].tolist(), y[part].tolist(), n[part].tolist())), gap)]
    return np.flatnonzero(~near), out


def _grow(equal: np.ndarray, penalty: int = 2) -> tuple[int, int]:
    """How far to go along ``equal`` so that matches less ``penalty`` x differences are most: (words, matches)."""
    if not len(equal):
        return 0, 0
    score = np.cumsum(np.where(equal, 1, -penalty))
    n = int(score.argmax()) + 1
    return (n, int(equal[:n].sum())) if score[n - 1] > 0 else (0, 0)


def align(a: np.ndarray, b: np.ndarray, b_from: int, chain: list[tuple[int, int, int]], margin: int):
    """(a first, a stop, b first, b stop, equal words) of a chain over the hashed words ``a`` and
    the part ``b`` of the other text that begins at its word ``b_from``."""
    x, y, _ = chain[0]
    y -= b_from
    m = min(x, y, margin)
    left, equal = _grow((a[x - m:x] == b[y - m:y])[::-1])
    begin = (x - left, y - left)
    end = begin
    for t, (x, y, n) in enumerate(chain):
        y -= b_from
        skip = max(0, end[0] - x, end[1] - y) if t else 0  # words that the extension before has taken
        stop = min(x + n, len(a)), min(y + n, len(b))
        n = min(stop[0] - x, stop[1] - y)
        if n > skip:
            equal += int((a[x + skip:x + n] == b[y + skip:y + n]).sum())
            end = (x + n, y + n)
        room = min(len(a) - end[0], len(b) - end[1], margin)
        if t + 1 < len(chain):
            room = min(room, max(0, chain[t + 1][0] - end[0]), max(0, chain[t + 1][1] - b_from - end[1]))
        more, same = _grow(a[end[0]:end[0] + room] == b[end[1]:end[1] + room])
        end, equal = (end[0] + more, end[1] + more), equal + same
    return begin[0], end[0], begin[1] + b_from, end[1] + b_from, equal


def accepted(a: np.ndarray, b: np.ndarray, b_from: int, chain: list, margin: int, min_words: int, identity: float) -> list[tuple]:
    """The passages of a chain, as ``align`` gives them: the whole one if enough of it is equal, else those of its two parts
    beside its widest gap; of a single piece, its runs of equal words."""
    out, todo = [], [chain]
    while todo:
        c = todo.pop()
        p = align(a, b, b_from, c, margin)
        if min(p[1] - p[0], p[3] - p[2]) < min_words:
            continue
        if p[4] >= identity * max(p[1] - p[0], p[3] - p[2]):
            out.append(p)
        elif len(c) > 1:
            gaps = [max(c[t + 1][0] - c[t][0] - c[t][2], c[t + 1][1] - c[t][1] - c[t][2]) for t in range(len(c) - 1)]
            t = int(np.argmax(gaps)) + 1
            todo += [c[:t], c[t:]]
        else:
            n = min(p[1] - p[0], p[3] - p[2])
            equal = np.r_[False, a[p[0]:p[0] + n] == b[p[2] - b_from:p[2] - b_from + n], False]
            edges = np.flatnonzero(equal[1:] != equal[:-1])
            out += [(p[0] + x, p[0] + y, p[2] + x, p[2] + y, y - x) for x, y in zip(edges[::2].tolist(), edges[1::2].tolist()) if y - x >= min_words]
    return out


def _grown(a: np.ndarray, at: np.ndarray, b: np.ndarray, bt: np.ndarray, room: np.ndarray, margin: int, step: int) -> tuple[np.ndarray, np.ndarray]:
    """``_grow`` for many places: ``room`` words of a and b from ``at`` and ``bt`` on, forward or backward."""
    j = np.arange(margin)
    inside = j < room[:, None]
    same = a[np.where(inside, at[:, None] + step * j, 0)] == b[np.where(inside, bt[:, None] + step * j, 0)]
    score = np.cumsum(np.where(inside & same, 1, -2), axis=1)
    n = score.argmax(1)
    best = np.maximum(score[np.arange(len(n)), n], 0)
    n = np.where(best > 0, n + 1, 0)
    return n, (best + 2 * n) // 3


def aligned_pieces(a: np.ndarray, a_bounds: tuple, b: np.ndarray, b_bounds: tuple, x: np.ndarray, y: np.ndarray, n: np.ndarray, margin: int) -> np.ndarray:
    """``align`` for many chains of one piece each: rows of (a first, a stop, b first, b stop, equal words), places within their texts.  Chain t is
    over the words ``a_bounds[0][t]`` to ``a_bounds[1][t]`` of a and the like of b; y is a place of its part of b."""
    out = np.zeros((len(x), 5), np.int64)
    step = max(1, AT_ONCE // max(1, margin))
    for i in range(0, len(x), step):
        part = slice(i, i + step)
        (af, az), (bf, bz) = ((v[0][part], v[1][part]) for v in (a_bounds, b_bounds))
        p, q = af + x[part], bf + y[part]
        left, equal = _grown(a, p - 1, b, q - 1, np.where(q <= bz, np.minimum(x[part], y[part]), 0), margin, -1) if margin and len(b) else (0 * p, 0 * p)
        m = np.minimum(n[part], np.minimum(az - p, bz - q))
        end = np.where(m > 0, m, -left)
        for t in np.flatnonzero(m > 256).tolist():
            equal[t] += (a[p[t]:p[t] + m[t]] == b[q[t]:q[t] + m[t]]).sum()
        few = np.where(m > 256, 0, np.maximum(m, 0))
        each = np.repeat(np.arange(len(m)), few)
        k = np.arange(len(each)) - np.repeat(np.cumsum(few) - few, few)
        equal = equal + np.bincount(each, a[p[each] + k] == b[q[each] + k], len(m)).astype(np.int64)
        right, same = _grown(a, p + end, b, q + end, np.minimum(az - p - end, bz - q - end), margin, 1) if margin and len(b) else (0 * p, 0 * p)
        out[part] = np.stack([x[part] - left, x[part] + end + right, y[part] - left, y[part] + end + right, equal + same], axis=1)
    return out


def _numbers(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(all 64-bit numbers of a binary column, where each row's begin and the last one's stop), uncopied."""
    column = column.cast(pa.large_binary())
    _, ends, data = column.buffers()
    ends = np.frombuffer(ends, np.int64)[column.offset:column.offset + len(column) + 1] if len(column) else np.zeros(1, np.int64)
    size = int(ends[-1] - ends[0])
    return np.frombuffer(data, np.uint64, size // 8, int(ends[0])) if size else np.zeros(0, np.uint64), (ends - ends[0]) // 8


def _texts_of(rows: DataFrame, ids: DataFrame) -> DataFrame:
    """``id, text`` of the documents in ``ids``, after a slot table of fixed size has kept most others out."""
    slot = F.pmod(F.xxhash64("id"), F.lit(SLOTS))
    slots = ids.select(slot.alias("slot")).distinct()
    return rows.withColumn("slot", slot).join(F.broadcast(slots), "slot", "left_semi").select("id", "text")


def _passages(rows: DataFrame, matches: DataFrame, k: int, min_words: int, identity: float, gap: int, margin: int) -> DataFrame:
    """The accepted passages of ``matches`` (id, match_id, at, match_at): chained by pair of documents, then aligned."""

    def chain(part: pa.Table) -> pa.Table:
        """The matches of many pairs of documents, sorted by pair."""
        ids, match_ids, x, y = (part[c].to_numpy().astype(np.int64) for c in ("id", "match_id", "at", "match_at"))
        order = np.lexsort((match_ids, ids))
        ids, match_ids, x, y = ids[order], match_ids[order], x[order], y[order]
        starts = np.flatnonzero(np.r_[True, (ids[1:] != ids[:-1]) | (match_ids[1:] != match_ids[:-1])][:len(ids)])
        pair, x, y, n = pieces_of_pairs(np.repeat(np.arange(len(starts)), np.diff(np.r_[starts, len(ids)])), x, y, k, gap)
        ids, match_ids = ids[starts], match_ids[starts]
        alone, out = chains_of_pairs(pair, x, y, n, gap)
        of = np.r_[pair[alone], np.array([t for t, _ in out], np.int64)]
        flat = np.r_[np.stack([x[alone], y[alone], n[alone]], axis=1).ravel(), np.array([v for _, c in out for p in c for v in p], np.int64)]
        ends = np.r_[0, np.cumsum(np.r_[np.full(len(alone), 3), np.array([3 * len(c) for _, c in out], np.int64)])]
        last = np.r_[y[alone] + n[alone], np.array([c[-1][1] + c[-1][2] for _, c in out], np.int64)]
        return pa.table({"id": ids[of], "match_id": match_ids[of],
                         "from": pa.array(np.maximum(0, flat[ends[:-1] + 1] - margin), pa.int32()), "to": pa.array(last + margin, pa.int32()),
                         "chain": pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(flat, pa.int32()))})

    matches = stored(matches, "passage-matches")
    deal = F.pmod(F.xxhash64("id", "match_id"), F.lit(max(1, matches.count() // 50_000)))  # many pairs to a call
    got = stored(matches.withColumn("deal", deal).groupBy("deal").applyInArrow(chain, "id bigint, match_id bigint, `from` int, `to` int, chain array<int>"), "passage-chains")

    # Words of the first places: each wanted stretch once, however many documents match it.
    wanted = got.select(F.col("match_id").alias("id"), "from", "to").distinct().groupBy("id").agg(F.collect_list(F.struct("from", "to")).alias("parts"))
    wanted = stored(wanted, "passage-wanted")

    def cut(batches):
        for batch in batches:
            for begin, texts in text_slices(batch.column(1), SLICE):
                ids, lists = batch.column(0).slice(begin, len(texts)).to_pylist(), batch.column(2).slice(begin, len(texts)).to_pylist()
                out = []
                for i, words, parts in zip(ids, hashed_words(texts), lists):
                    out += [(i, p["from"], p["to"], words[p["from"]:p["to"]].tobytes()) for p in parts]
                yield pa.record_batch({"match_id": pa.array([o[0] for o in out], pa.int64()), "from": pa.array([o[1] for o in out], pa.int32()),
                                       "to": pa.array([o[2] for o in out], pa.int32()), "words": pa.array([o[3] for o in out], pa.binary())})

    stretches = stored(_texts_of(rows, wanted).join(wanted.hint("shuffle_hash"), "id").select("id", "text", "parts")
                       .mapInArrow(cut, "match_id bigint, `from` int, `to` int, words binary"), "passage-stretches")
    per_doc = (got.join(stretches, ["match_id", "from", "to"])
               .groupBy("id").agg(F.collect_list(F.struct("match_id", "from", "chain", "words")).alias("chains")))
    per_doc = stored(per_doc, "passage-per-document")

    def aligned(batches):
        for batch in batches:
            for begin, texts in text_slices(batch.column(1), SLICE):
                lists = batch.column(2).slice(begin, len(texts))
                text = np.repeat(np.arange(len(texts)), pa.compute.list_value_length(lists).to_numpy())
                match_id, since, chain, words = lists.flatten().flatten()
                ids, match_id, since = batch.column(0).slice(begin, len(texts)).to_numpy()[text], match_id.to_numpy(), since.to_numpy().astype(np.int64)
                ends, flat = chain.offsets.to_numpy(), chain.values.to_numpy().astype(np.int64)
                a, bounds = joined_words(texts)
                af, az = bounds[text], bounds[text + 1]
                b, stops = _numbers(words)
                ok = flat[ends[1:] - 3] + flat[ends[1:] - 1] <= az - af  # else places of another text with the same id
                one = np.flatnonzero(ok & (np.diff(ends) == 3))
                x, y, n = flat[ends[one]], flat[ends[one] + 1] - since[one], flat[ends[one] + 2]
                got = aligned_pieces(a, (af[one], az[one]), b, (stops[one], stops[one + 1]), x, y, n, margin)
                got[:, 2:4] += since[one, None]
                long = np.minimum(got[:, 1] - got[:, 0], got[:, 3] - got[:, 2]) >= min_words
                good = long & (got[:, 4] >= identity * np.maximum(got[:, 1] - got[:, 0], got[:, 3] - got[:, 2]))
                of, rest = [one[good]], []
                for t in np.flatnonzero(ok & (np.diff(ends) > 3)).tolist() + one[long & ~good].tolist():
                    steps = list(zip(*(flat[ends[t] + c:ends[t + 1]:3].tolist() for c in range(3))))
                    found = accepted(a[af[t]:az[t]], b[stops[t]:stops[t + 1]], int(since[t]), steps, margin, min_words, identity)
                    of.append(np.full(len(found), t))
                    rest += found
                of = np.concatenate(of)
                got = np.concatenate([got[good], np.array(rest, np.int64).reshape(-1, 5)])
                whole = np.maximum(got[:, 1] - got[:, 0], got[:, 3] - got[:, 2])
                yield pa.record_batch({"id": pa.array(ids[of], pa.int64()), "first_word": pa.array(got[:, 0], pa.int32()), "stop_word": pa.array(got[:, 1], pa.int32()),
                                       "match_id": pa.array(match_id[of], pa.int64()), "match_first_word": pa.array(got[:, 2], pa.int32()),
                                       "match_stop_word": pa.array(got[:, 3], pa.int32()), "n_equal": pa.array(got[:, 4], pa.int32()), "identity": pa.array(got[:, 4] / whole, pa.float64())})

    schema = "id bigint, first_word int, stop_word int, match_id bigint, match_first_word int, match_stop_word int, n_equal int, identity double"
    out = _texts_of(rows, per_doc).join(per_doc.hint("shuffle_hash"), "id").select("id", "text", "chains").mapInArrow(aligned, schema)
    return stored(out.dropDuplicates(PLACE), "passage-found")


def _again(places: DataFrame, first: DataFrame, found: DataFrame, k: int, min_words: int, gap: int) -> DataFrame:
    """Matches for the seeds whose first place has led to no passage with another document: of a seed with at most ``FEW`` places
    with all of them; of others with the first places of it and its next shared seed, and of as many seeds as span ``min_words``."""
    covered = found.filter("id <> match_id").groupBy("id").agg(F.collect_set(F.struct("first_word", "stop_word")).alias("covered"))
    seeds = places.join(first.select("s", (F.col("n") > FEW).alias("hot")), "s").groupBy("id").agg(F.collect_set(F.struct("at", "s", "hot")).alias("seeds"))

    def keys(batches):
        for batch in batches:
            ids, lists, parts = batch.column(0).to_numpy(), *(batch.column(c) for c in (1, 2))
            a, s, hot = (c.to_numpy(zero_copy_only=False) for c in lists.flatten().flatten())
            text = np.repeat(np.arange(len(ids)), pa.compute.list_value_length(lists).to_numpy())
            order = np.lexsort((hot, s, a, text))
            a, s, hot, text = a[order].astype(np.int64), s[order], hot[order], text[order]
            of = np.repeat(np.arange(len(ids)), pa.compute.fill_null(pa.compute.list_value_length(parts), 0).to_numpy())
            since, until = (c.to_numpy().astype(np.int64) for c in parts.flatten().flatten())
            whole = until - since >= k
            wide = int(max(a.max(initial=0), until.max(initial=0))) + gap + k + min_words + 2
            at = text * wide + a  # ascends over all texts
            inside = np.searchsorted(np.sort((of * wide + since)[whole]), at, "right") - np.searchsorted(np.sort((of * wide + until - k + 1)[whole]), at, "right")
            cold = np.flatnonzero(~hot)
            asks, out = inside == 0, [(cold, cold, 0, s[cold])]
            breaks = np.r_[0, np.cumsum((np.diff(a) > gap + k) | (np.diff(text) > 0))]
            with np.errstate(over="ignore"):
                power, back = (np.cumprod(np.full(len(s), b, np.uint64)) for b in (MIX, np.uint64(pow(int(MIX), -1, 1 << 64))))
                mixed = s.astype(np.int64).view(np.uint64)
                sums = np.r_[np.uint64(0), np.cumsum((mixed ^ (mixed >> np.uint64(31))) * power)]
                for kind, span in ((1, k + 1), (2, min_words)):
                    last = np.maximum(np.searchsorted(at, at + span - k), np.arange(len(at)) + 1)
                    begin = np.flatnonzero(hot & (last < len(at)))
                    begin = begin[breaks[last[begin]] == breaks[begin]]
                    key = (sums[last[begin] + 1] - sums[begin]) * back[begin]  # the same wherever in the text
                    out.append((begin, last[begin], kind, signed(key)))
            for begin, last, kind, key in out:
                yield pa.record_batch({"id": pa.array(ids[text[begin]], pa.int64()), "a": pa.array(a[begin], pa.int32()), "z": pa.array(a[last], pa.int32()),
                                       "kind": pa.array(np.full(len(begin), kind), pa.int32()), "key": pa.array(key, pa.int64()), "asks": pa.array(asks[begin], pa.bool_())})

    got = stored(seeds.join(covered, "id", "left").select("id", "seeds", "covered")
                 .mapInArrow(keys, "id bigint, a int, z int, kind int, key bigint, asks boolean"), "passage-keys")
    asks = got.filter("asks").drop("asks")
    few = got.filter("kind = 0").select("key", F.col("id").alias("match_id"), F.col("a").alias("match_at"))
    out = asks.filter("kind = 0").join(few, "key").filter("match_id < id").select("id", "match_id", F.col("a").alias("at"), "match_at")
    least = got.filter("kind > 0").groupBy("kind", "key").agg(F.min(F.struct("id", "a", "z")).alias("f"))
    both = asks.join(least, ["kind", "key"]).filter("f.id < id")
    ends = F.explode(F.array(F.struct(F.col("a").alias("at"), F.col("f.a").alias("match_at")), F.struct(F.col("z").alias("at"), F.col("f.z").alias("match_at"))))
    return out.unionByName(both.select("id", F.col("f.id").alias("match_id"), ends.alias("e")).select("id", "match_id", "e.at", "e.match_at"))


def repeated(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", k: int = 8, w: int = 10, min_words: int = 25,
             report_words: int = 50, identity: float = 0.8, gap: int = 32, margin: int = 64) -> DataFrame:
    """``id, first_word, stop_word, match_id, match_first_word, match_stop_word, n_equal, identity`` per
    passage of ``id`` that ``match_id`` (another document with a smaller id, or the same one at least ``min_words`` earlier)
    has as well, if the passage and those it touches span ``report_words`` words or more.  Words are runs of
    characters other than ASCII white space, A-Z lower-cased."""
    rows = docs.select(F.col(id_col).cast("bigint").alias("id"), F.col(text_col).alias("text")).filter("id IS NOT NULL")

    def seeds(batches):
        for batch in batches:
            for begin, texts in text_slices(batch.column(1), SLICE):
                hashes, bounds = xxh_words(texts)
                text, s, at = minimizers_of_texts(hashes, bounds, k, w)
                enough = (np.diff(bounds) >= min_words)[text]
                text, s, at = text[enough], s[enough], at[enough]
                ends = pa.array(np.searchsorted(text, np.arange(len(texts) + 1)), pa.int32())
                columns = {"s": pa.array(signed(s), pa.int64()), "at": pa.array(at, pa.int32()), "own": pa.array(own_places(s, at, min_words, text), pa.int32())}
                yield pa.record_batch({"id": batch.column(0).slice(begin, len(texts)), **{c: pa.ListArray.from_arrays(ends, v) for c, v in columns.items()}})

    found = stored(rows.mapInArrow(seeds, "id bigint, s array<bigint>, at array<int>, own array<int>").filter("size(s) > 0"), "passage-seeds")
    shared = stored(found.select(F.explode("s").alias("s")).groupBy("s").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select("s"), "passage-shared")
    places = found.select("id", F.explode(F.arrays_zip("s", "at", "own")).alias("p")).select("id", "p.s", "p.at", "p.own")
    places = stored(places.join(shared, "s"), "passage-places")  # repeated rows repeat their places
    first = stored(places.groupBy("s").agg(F.min(F.struct("id", "at")).alias("f"), F.count(F.lit(1)).alias("n")).filter("n > 1")
                   .select("s", F.col("f.id").alias("match_id"), F.col("f.at").alias("match_at"), "n"), "passage-first")
    matches = places.join(first, "s").filter("id <> match_id").select("id", "match_id", "at", "match_at")
    matches = matches.unionByName(places.filter("own >= 0").select("id", F.col("id").alias("match_id"), "at", F.col("own").alias("match_at")))

    found = _passages(rows, matches, k, min_words, identity, gap, margin)
    again = _again(places, first, found, k, min_words, gap)
    passages = found.unionByName(_passages(rows, again, k, min_words, identity, gap, margin)).dropDuplicates(PLACE)
    # Passages that touch make a stretch; short parts count where their stretch is long enough.
    by = Window.partitionBy("id").orderBy("first_word", "stop_word")
    reach = F.max("stop_word").over(by.rowsBetween(Window.unboundedPreceding, -1))
    stretch = F.sum(F.when(F.col("_reach") >= F.col("first_word"), 0).otherwise(1)).over(by.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    whole = Window.partitionBy("id", "_stretch")
    return (passages.withColumn("_reach", reach).withColumn("_stretch", stretch)
            .withColumn("_words", F.max("stop_word").over(whole) - F.min("first_word").over(whole))
            .filter(F.col("_words") >= report_words).drop("_reach", "_stretch", "_words"))
