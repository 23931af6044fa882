"""Suffix-array dedup: remove bytes of 50-byte strings that also start in a document of a smaller id.

Sparse suffixes. The least hash among the 16-byte strings inside a 50-byte window marks the
window's *anchor*; equal windows have equal anchors at equal places, so two documents share a
window only if they share its anchor. Consecutive windows of one anchor make a *run* of 50 to
84 bytes, about one for every 18 bytes of text. The suffixes that start at anchors are what is
indexed: an entry is the first 16 bytes of the suffix (the anchor itself), the hash of the run
around it, and the least document that has it.

Logarithmic index family, one for each range of hashed anchors. Entries come in by document, a
batch at a time. A batch gets its (sparse) suffix array and is merge-scanned against the levels
that exist when it arrives, which hold no larger document: a place in the order of a level shows
an equal run there, or in its neighbours another run of the same anchor. What no level has forms
a new level, and levels that are not larger merge with it geometrically. An entry that a level
has already never enters the family, so a hot passage is one entry of it.

1. A run found whole in a smaller document is removed whole.
2. Where an anchor has several runs, the first document of each sends the run's bytes, and
   their windows are compared one by one. This settles the ends of repeated passages exactly.

Hot passages: a block asks once per distinct entry, so a passage that is everywhere is one
entry per block. Memory of a task is one block or one key range. The runs of an anchor stay
together; where there are very many, windows are compared a few places of the anchor at a time,
as equal windows have it at equal places. Anchors are compared by their bytes in the family and
by 64 bits of hash among windows, runs and windows by 64 bits besides.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tiercast.llm import words as W
from tiercast.llm.tables import ship
from tiercast.llm.text_blocks import key_ranges, opened, stage_blocks
from tiercast.plans.staging import stage

WIDTH = 50
ANCHOR = 16
SPAN = WIDTH - ANCHOR + 1  # anchors a window can have, and windows a run can have
BLOCK_BYTES = 1 << 20
RANGE_BYTES = 8 << 20  # of text for each key range
STRETCH = 8192  # runs whose windows are compared at a time
WINDOWS = STRETCH * SPAN  # windows that are compared at a time; of an anchor with more, one place at least
BATCH = 1 << 15  # entries of a batch that comes to a family
_LAST = np.iinfo(np.int64).max  # null ids come last


def _eights(raw: np.ndarray) -> np.ndarray:
    """The eight bytes from each position as one number."""
    wide = np.concatenate([raw, np.zeros(8, np.uint8)])
    return np.lib.stride_tricks.as_strided(wide, (len(raw), 8), (1, 1)).copy().view(W.U64).ravel()


class Runs:
    """The runs of one block, and their distinct entries in index order."""

    def __init__(self, head: bytes, text: bytes):
        ids, missing, self.raw, self.offsets = opened(head, text)
        self.ids, self.missing = ids, missing
        rank = np.where(missing.astype(bool), _LAST, ids)
        raw, offsets = self.raw, self.offsets
        self.first = self.count = self.owner = self.anchor = np.zeros(0, np.int64)
        self.key = self.run = np.zeros(0, W.U64)
        if len(raw) >= WIDTH:
            eight = _eights(raw)
            n = len(raw) - ANCHOR + 1
            gram = W.mix(eight[:n] * W.U64(0x9E3779B97F4A7C15) ^ W.mix(eight[8 : 8 + n]))
            del eight
            # The least of each window: hash above, place below, so ties go to the leftmost.
            least = (gram & W.U64(0xFFFFFFFF00000000)) | np.arange(n, dtype=W.U64)
            width = 1
            while width * 2 <= SPAN:
                least = np.minimum(least[:-width], least[width:])
                width *= 2
            if width < SPAN:
                least = np.minimum(least[: -(SPAN - width)], least[SPAN - width :])
            anchor = (least & W.U64(0xFFFFFFFF)).astype(np.int64)
            del least
            inside = np.ones(len(anchor), bool)  # windows that do not cross into the next text
            for k in range(1, WIDTH):
                at = offsets[1:-1] - k
                inside[at[(at >= 0) & (at < len(anchor))]] = False
            windows = np.flatnonzero(inside)
            at = anchor[windows]
            begins = np.ones(len(windows), bool)
            begins[1:] = at[1:] != at[:-1]
            places = np.flatnonzero(begins)
            self.first = windows[places]
            self.count = np.diff(np.append(places, len(windows)))
            self.anchor = at[places]
            self.key = gram[self.anchor]
            self.run = W.range_hashes(raw, self.first, self.first + self.count + WIDTH - 1)
            self.owner = np.searchsorted(offsets, self.first, side="right") - 1
        doc = rank[self.owner]
        order = np.lexsort((doc, self.run, self.key))
        key, run = self.key[order], self.run[order]
        new = np.ones(len(order), bool)
        new[1:] = (key[1:] != key[:-1]) | (run[1:] != run[:-1])
        #: Distinct entries: key, run, least document and a run of it; ``entry`` of every run.
        self.keys, self.runs, self.docs, self.sample = key[new], run[new], doc[order][new], order[new]
        self.entry = np.empty(len(order), np.int64)
        self.entry[order] = np.cumsum(new) - 1
        self.doc = doc


def _cuts(keys: np.ndarray, ranges: int) -> np.ndarray:
    edges = np.array([(r << 64) // ranges for r in range(ranges)], W.U64)
    return np.append(np.searchsorted(keys, edges), len(keys))


class Level:
    """A sparse suffix array: suffixes in order, the entry that each came from, and their anchors numbered."""

    def __init__(self, suffixes: np.ndarray, entries: np.ndarray):
        self.suffixes, self.entries = suffixes, entries
        self.anchors = np.cumsum(_turns(suffixes)) - 1

    def __len__(self) -> int:
        return len(self.suffixes)


def _wide(suffixes: np.ndarray) -> np.ndarray:
    """Suffixes of 16 bytes and a hash as three numbers each, to tell equal ones (not their order)."""
    return suffixes.view(W.U64).reshape(-1, 3)


def _turns(suffixes: np.ndarray) -> np.ndarray:
    """Where, in suffix order, an anchor differs from the one before."""
    wide = _wide(suffixes)
    new = np.ones(len(wide), bool)
    new[1:] = (wide[1:, :2] != wide[:-1, :2]).any(axis=1)
    return new


class Family:
    """Levels over ``n`` entries that are added batch by batch, no document smaller than one before.

    ``first`` is the entry of the family that equals an entry, ``several`` says of entries of
    the family whether their anchor has other runs there.
    """

    def __init__(self, n: int):
        self.levels: list[Level] = []
        self.first = np.arange(n)
        self.several = np.zeros(n, bool)

    def add(self, suffixes: np.ndarray, entries: np.ndarray) -> None:
        """Sort a batch into its suffix array, scan it against every level, and let its new suffixes be a level."""
        order = np.argsort(suffixes, kind="stable")  # among equal ones the first to come leads
        suffixes, entries = suffixes[order], entries[order]
        new = np.ones(len(order), bool)
        new[1:] = suffixes[1:] != suffixes[:-1]
        self.first[entries] = entries[new][np.cumsum(new) - 1]
        suffixes, entries = suffixes[new], entries[new]
        unseen = np.ones(len(entries), bool)
        for level in self.levels:
            unseen &= ~self._scan(level, suffixes, entries)
        level = Level(suffixes[unseen], entries[unseen])
        self._mark(level, np.flatnonzero(np.bincount(level.anchors) > 1))
        while self.levels and len(self.levels[-1]) <= len(level):
            level = self._merged(self.levels.pop(), level)
        if len(level):
            self.levels.append(level)

    def _scan(self, level: Level, suffixes: np.ndarray, entries: np.ndarray) -> np.ndarray:
        """Which suffixes the level has; where it has others of their anchors, all of them are marked."""
        at = np.searchsorted(level.suffixes, suffixes)
        asked, held = _wide(suffixes), _wide(level.suffixes)
        found = np.zeros(len(at), bool)
        for place in (np.minimum(at, len(level) - 1), np.maximum(at - 1, 0)):
            anchor = (held[place, :2] == asked[:, :2]).all(axis=1)
            equal = anchor & (held[place, 2] == asked[:, 2])
            self.first[entries[equal]] = level.entries[place[equal]]
            found |= equal
            other = anchor & ~found
            self.several[entries[other]] = True
            self._mark(level, level.anchors[place[other]])
        return found

    def _mark(self, level: Level, anchors: np.ndarray) -> None:
        marked = np.zeros(len(level) + 1, bool)
        marked[anchors] = True
        self.several[level.entries[marked[level.anchors]]] = True

    @staticmethod
    def _merged(large: Level, small: Level) -> Level:
        at = np.searchsorted(large.suffixes, small.suffixes)
        return Level(np.insert(large.suffixes, at, small.suffixes), np.insert(large.entries, at, small.entries))

    def answers(self) -> tuple[np.ndarray, np.ndarray]:
        """Of every entry: its equal in the family, and whether the anchor has several runs."""
        first = self.first[self.first]  # of the batch, and from there of the level
        return first, self.several[first]


def _asks(blocks: DataFrame, ranges: int) -> DataFrame:
    def in_task(batches):
        for batch in batches:
            for block, head, text in zip(*(batch.column(c).to_pylist() for c in ("block", "head", "text"))):
                r = Runs(head, text)
                cuts = _cuts(r.keys, ranges)
                some = [k for k in range(ranges) if cuts[k + 1] > cuts[k]]
                anchors = r.raw[r.anchor[r.sample][:, None] + np.arange(ANCHOR)].view(W.U64)
                data = [W.squeeze(anchors[a:b, 0], anchors[a:b, 1], r.runs[a:b], r.docs[a:b]) for a, b in ((cuts[k], cuts[k + 1]) for k in some)]
                yield pa.RecordBatch.from_arrays([pa.array(some, pa.int32()), pa.array([block] * len(some), pa.int64()), pa.array(data, pa.binary())], names=["range", "block", "data"])

    return blocks.select("block", "head", "text").mapInArrow(in_task, "range int, block long, data binary")


WHOLE, SEVERAL = 1, 2


def _answer_runs(table: pa.Table, batch: int) -> pa.Table:
    """Index one key range and answer each block: 1 if a smaller document has the run, 2 if its windows are to be compared."""
    suffixes, docs = [], []
    for data in table.column("data"):
        *parts, doc = W.unsqueeze(data.as_py(), np.uint64, np.uint64, np.uint64, np.int64)
        suffixes.append(np.stack(parts, axis=1).view(f"S{ANCHOR + 8}").ravel())
        docs.append(doc)
    ends = np.cumsum([len(d) for d in docs])
    doc, suffixes = np.concatenate(docs), np.concatenate(suffixes)
    del docs
    family = Family(len(doc))
    arrival = np.argsort(doc, kind="stable")
    for at in range(0, len(doc), batch):
        entries = arrival[at : at + batch]
        family.add(suffixes[entries], entries)
    first, several = family.answers()
    answer = np.where(doc[first] < doc, WHOLE, np.where(several, SEVERAL, 0)).astype(np.uint8)
    out = [W.squeeze(part) for part in np.split(answer, ends[:-1])]
    return pa.table({"block": table.column("block"), "range": table.column("range"), "kind": pa.array([1] * len(out), pa.int32()), "data": pa.array(out, pa.binary())})


_ANSWERS = "block long, range int, kind int, data binary"


def _joined(table: pa.Table, kind: int, dtype: type) -> np.ndarray:
    """One kind of a block's answers in the order of its entries."""
    rows = [(r, d) for r, k, d in zip(*(table.column(c).to_pylist() for c in ("range", "kind", "data"))) if k == kind]
    return np.concatenate([np.zeros(0, dtype), *[W.unsqueeze(d, dtype)[0] for _, d in sorted(rows)]])


def _contexts(blocks: DataFrame, answers: DataFrame, ranges: int) -> DataFrame:
    """The bytes of runs whose anchor has several: ``range, block, data, bytes``."""

    def of_block(left: pa.Table, right: pa.Table) -> pa.Table:
        out = []
        for block, head, text in zip(*(left.column(c).to_pylist() for c in ("block", "head", "text"))):
            r = Runs(head, text)
            chosen = np.flatnonzero(_joined(right, 1, np.uint8) == SEVERAL)
            cuts = _cuts(r.keys[chosen], ranges)
            for k in range(ranges):
                part = chosen[cuts[k] : cuts[k + 1]]
                if len(part):
                    first, count = r.first[r.sample[part]], r.count[r.sample[part]]
                    place = r.anchor[r.sample[part]] - first
                    data = W.squeeze(np.diff(r.keys[part], prepend=W.U64(0)), r.docs[part], count.astype(np.uint8), place.astype(np.uint8))
                    out.append((k, block, data, W.squeeze(r.raw[W.spread(first, count + WIDTH - 1)])))
        names = ("range", "block", "data", "bytes")
        kinds = (pa.int32(), pa.int64(), pa.binary(), pa.binary())
        columns = list(zip(*out)) or [()] * 4
        return pa.table({n: pa.array(c, t) for n, c, t in zip(names, columns, kinds)})

    texts = blocks.select("block", "head", "text").groupBy("block")
    return texts.cogroup(answers.groupBy("block")).applyInArrow(of_block, "range int, block long, data binary, bytes binary")


def _window_hits(key: np.ndarray, doc: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    """Which windows a smaller document has, of windows with the hashes of their anchor and of themselves."""
    order = np.lexsort((doc, hashes, key))
    new = np.ones(len(order), bool)
    new[1:] = (key[order][1:] != key[order][:-1]) | (hashes[order][1:] != hashes[order][:-1])
    least = doc[order][new][np.cumsum(new) - 1]
    hit = np.zeros(len(order), bool)
    hit[order] = least < doc[order]
    return hit


def _window_masks(key: np.ndarray, doc: np.ndarray, count: np.ndarray, place: np.ndarray, begin: np.ndarray, raw: np.ndarray) -> np.ndarray:
    """For runs that begin in ``raw``, with their anchors' places: a bit per window that a smaller document has."""
    masks = np.zeros(len(count), W.U64)
    turns = min(SPAN, -(-int(count.sum()) // WINDOWS))
    for turn in range(turns):
        which, bit, hashes = [], [], []
        for at in range(0, len(count), STRETCH):
            some = slice(at, at + STRETCH)
            size = count[some] + WIDTH - 1
            near = raw[W.spread(begin[some], size)]
            run = np.repeat(np.arange(len(size)), count[some])
            nth = W.spread(np.zeros(len(size), np.int64), count[some])
            mine = (place[some][run] - nth) % turns == turn  # where the anchor lies in the window
            run, nth = run[mine], nth[mine]
            windows = (np.cumsum(size) - size)[run] + nth
            hashes.append(W.range_hashes(near, windows, windows + WIDTH))
            which.append(run + at)
            bit.append(nth.astype(np.uint8))
        which, bit, hashes = np.concatenate(which), np.concatenate(bit), np.concatenate(hashes)
        hit = _window_hits(key[which], doc[which], hashes)
        np.bitwise_or.at(masks, which[hit], W.U64(1) << bit[hit].astype(W.U64))
    return masks


def _answer_windows(table: pa.Table) -> pa.Table:
    """Compare the windows of all runs of one key range, a stretch of keys at a time."""
    parts = [W.unsqueeze(d.as_py(), np.uint64, np.int64, np.uint8, np.uint8) for d in table.column("data")]
    raw = np.concatenate([W.unsqueeze(b.as_py(), np.uint8)[0] for b in table.column("bytes")])
    key = np.concatenate([np.cumsum(p[0], dtype=np.uint64) for p in parts])
    doc = np.concatenate([p[1] for p in parts])
    count, place = (np.concatenate([p[k] for p in parts]).astype(np.int64) for k in (2, 3))
    ends = np.cumsum([len(p[0]) for p in parts])
    del parts
    size = count + WIDTH - 1
    begin = np.cumsum(size) - size
    order = np.argsort(key, kind="stable")
    ranked = key[order]
    masks = np.zeros(len(key), W.U64)
    first = 0
    while first < len(order):
        last = min(first + STRETCH, len(order))
        last = int(np.searchsorted(ranked, ranked[last - 1], side="right"))  # an anchor's runs stay together
        some = order[first:last]
        masks[some] = _window_masks(key[some], doc[some], count[some], place[some], begin[some], raw)
        first = last
    out = [W.squeeze(part) for part in np.split(masks, ends[:-1])]
    return pa.table({"block": table.column("block"), "range": table.column("range"), "kind": pa.array([2] * len(out), pa.int32()), "data": pa.array(out, pa.binary())})


def _removed(r: Runs, answers: pa.Table) -> np.ndarray:
    """Which bytes of the block go."""
    answer, masks = _joined(answers, 1, np.uint8), _joined(answers, 2, np.uint64)
    edge = np.zeros(len(r.raw) + 1, np.int32)
    if len(r.entry):
        whole = (answer[r.entry] == WHOLE) | (r.doc > r.docs[r.entry])
        np.add.at(edge, r.first[whole], 1)
        np.add.at(edge, r.first[whole] + r.count[whole] + WIDTH - 1, -1)
        mask = np.zeros(len(r.keys), W.U64)
        mask[answer == SEVERAL] = masks
        open_runs = np.flatnonzero(~whole & (mask[r.entry] > 0))
        for k in range(SPAN):
            some = open_runs[(mask[r.entry[open_runs]] >> W.U64(k)) & W.U64(1) > 0]
            np.add.at(edge, r.first[some] + k, 1)
            np.add.at(edge, r.first[some] + k + WIDTH, -1)
    return np.cumsum(edge[:-1]) > 0


_RESULT = "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string, spans array<long>, kept binary"


def dedup(docs: DataFrame, ranges: int | None = None, block_bytes: int = BLOCK_BYTES, kept: bool = True, batch: int = BATCH) -> DataFrame:
    """A row per document: ``doc_id, n_bytes, n_removed, n_spans, kept_sha256, spans, kept``.

    ``spans`` lists starts and ends of the removed byte runs in turn, ``kept`` the remaining
    bytes (null if not asked for). A null text is empty; texts under 50 bytes stay whole. Null
    ids count as larger than any other and as equal to each other; rows that repeat an id are
    one document to others and do not remove each other's bytes. Other columns are ignored, an
    empty table gives an empty result. ``ranges`` is the number of key ranges, by default one for
    ``RANGE_BYTES`` of text, and four for each shuffle partition at least; ``batch`` that of the
    entries that come to a range's family at a time. Neither changes the answer.
    """
    spark = docs.sparkSession
    ship(spark)
    blocks = stage_blocks(docs, block_bytes)
    ranges = ranges or key_ranges(blocks, block_bytes, RANGE_BYTES)

    def of_range(table: pa.Table) -> pa.Table:
        return _answer_runs(table, batch)

    first = stage(_asks(blocks, ranges).groupBy("range").applyInArrow(of_range, _ANSWERS), "suffix-answers")
    second = stage(_contexts(blocks, first, ranges).groupBy("range").applyInArrow(_answer_windows, _ANSWERS), "window-answers")

    def of_block(left: pa.Table, right: pa.Table) -> pa.Table:
        out = []
        for head, text in zip(*(left.column(c).to_pylist() for c in ("head", "text"))):
            r = Runs(head, text)
            gone = _removed(r, right)
            for k, (a, b) in enumerate(zip(r.offsets[:-1].tolist(), r.offsets[1:].tolist())):
                mine = gone[a:b]
                turns = np.flatnonzero(np.diff(mine.astype(np.int8), prepend=0, append=0))
                rest = r.raw[a:b][~mine].tobytes()
                name = None if r.missing[k] else int(r.ids[k])
                out.append((name, b - a, b - a - len(rest), len(turns) // 2, hashlib.sha256(rest).hexdigest(), turns, rest if kept else None))
        names = ("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "spans", "kept")
        kinds = (pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.list_(pa.int64()), pa.binary())
        columns = list(zip(*out)) or [()] * 7
        return pa.table({n: pa.array(c, t) for n, c, t in zip(names, columns, kinds)})

    texts = blocks.select("block", "head", "text").groupBy("block")
    return texts.cogroup(first.unionByName(second).groupBy("block")).applyInArrow(of_block, _RESULT)
