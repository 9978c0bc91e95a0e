"""The array work of word co-occurrence, run by Python workers on whole blocks of lines.

A chunk holds many lines: its distinct words once, and the lines as places in that list. ``dealt`` sends the words of a line, for each
of its words, to the tile of that word; ``added`` adds up the pairs of a task's tiles. Rows stay large and binary, so that the engine
handles no pair by itself before it is added up.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext

CHUNK_WORDS = 1 << 19   # words of a chunk's lines; a longer line is alone
BUFFER_PAIRS = 1 << 22  # pairs that a task holds before it adds them up
SENT_PAIRS = 1 << 21    # pairs of a row that is shuffled
FREQUENT = 256          # so many words have their partners dealt to several tiles, where all partners of a word are wanted
SPREAD = 8              # tiles of such a word
COMMON = 1 << 17        # so many of the first words are known to all tasks; the others travel with the lines

CHUNKS = "chunk bigint, words array<string>, lines array<int>, codes binary, times binary, sizes binary, copies binary"
NUMBERED = "words string, numbers binary, codes binary, times binary, sizes binary, copies binary, starts binary, " \
    "stops binary, n_words bigint, n_pairs bigint, n_whole bigint"
DEALT = "x_tile int, words string, numbers binary, x binary, t binary, sizes binary, ys binary, twice binary, ns binary"
PAIRS = "x int, ys array<int>, ns array<bigint>"
SUMS = "first int, n_partners bigint, n_pairs bigint, top_count bigint, bound bigint"
STRIPES = "word string, part int, stripe map<string,bigint>"

Batches = Iterator[pa.RecordBatch]
Block = tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray, pa.Array]  # x, partners of each, y, n; numbers and their words


def packed(a: np.ndarray) -> bytes:
    """Whole numbers from 0, each in as few bytes as the largest one needs; the first byte tells how many."""
    top = int(a.max()) if len(a) else 0
    kind = np.dtype(next(t for t in ("u1", "u2", "u4", "i8") if top <= np.iinfo(t).max))
    return bytes([kind.itemsize]) + a.astype(kind, copy=False).tobytes()


def unpacked(data: pa.Buffer) -> np.ndarray:
    kind = {1: "u1", 2: "u2", 4: "u4", 8: "i8"}[np.frombuffer(data, "u1", 1)[0]]
    return np.frombuffer(data, kind, offset=1)


def _joined(words: pa.Array) -> str:
    return pc.binary_join(pa.ListArray.from_arrays([0, len(words)], words), "\n")[0].as_py()


def _row(schema: str, *values) -> pa.RecordBatch:
    """One row of numbers, bytes and arrays."""
    kinds = {"bigint": pa.int64(), "int": pa.int32(), "binary": pa.binary(), "string": pa.string()}
    fields = [f.split() for f in schema.split(", ")]
    arrays = [pa.ListArray.from_arrays([0, len(v)], v) if isinstance(v, pa.Array) else pa.array([v], kinds[kind])
              for v, (_, kind) in zip(values, fields)]
    return pa.RecordBatch.from_arrays(arrays, [name for name, _ in fields])


def _rows(batches: Batches) -> Iterator[dict]:
    """Each row as a dict: unpacked numbers (``codes`` and ``ys`` in their own width), arrays, and the words of a joined string."""
    for batch in batches:
        for i in range(batch.num_rows):
            row = {}
            for name, kind in zip(batch.schema.names, batch.schema.types):
                value = batch.column(name)[i]
                if pa.types.is_binary(kind):
                    row[name] = unpacked(value.as_buffer())
                    if name not in ("codes", "ys"):
                        row[name] = row[name].astype(np.int64)
                elif pa.types.is_list(kind):
                    row[name] = value.values
                elif pa.types.is_string(kind):
                    row[name] = pc.list_flatten(pc.split_pattern(pa.array([value] if len(value.as_buffer()) else [], pa.string()), "\n"))
                else:
                    row[name] = value.as_py()
            yield row


def _runs(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The places start, start + 1, ... of every run, one run after the other."""
    ends = np.cumsum(sizes)
    return np.arange(ends[-1] if len(ends) else 0) + np.repeat(starts - (ends - sizes), sizes)


def _cuts(*keys: np.ndarray) -> Iterator[tuple[int, int]]:
    """First place and end of every run of equal keys."""
    if len(keys[0]):
        new = np.any([k[1:] != k[:-1] for k in keys], axis=0)
        ends = [0, *(np.flatnonzero(new) + 1).tolist(), len(keys[0])]
        yield from zip(ends, ends[1:])


def chunked(batches: Batches) -> Batches:
    """Lines (``joined``: sorted words with a blank between, ``copies``) as chunks, each with words of its own."""
    number = TaskContext.get().partitionId() << 32
    held, words = [], 0
    for batch in batches:
        batch = batch.filter(pc.fill_null(pc.not_equal(batch.column("joined"), ""), False))
        ends, at = np.cumsum(pc.count_substring(batch.column("joined"), " ").to_numpy(zero_copy_only=False).astype(np.int64) + 1), 0
        while at < len(ends):
            before = int(ends[at - 1]) if at else 0
            stop = max(int(np.searchsorted(ends, before + CHUNK_WORDS - words, "right")), at if held else at + 1)
            if stop > at:
                held.append(batch.slice(at, stop - at))
                words, at = words + int(ends[stop - 1]) - before, stop
            if at < len(ends):
                yield _chunk(number, held)
                number, held, words = number + 1, [], 0
    if held:
        yield _chunk(number, held)


def _chunk(number: int, held: list[pa.RecordBatch]) -> pa.RecordBatch:
    table = pa.Table.from_batches(held).combine_chunks()
    lists = pc.split_pattern(table.column("joined").chunk(0), " ")
    told = pc.list_flatten(lists).dictionary_encode()
    codes, line = told.indices.to_numpy(), np.repeat(np.arange(len(lists)), pc.list_value_length(lists).to_numpy())
    new = np.ones(len(codes), bool)  # a line is sorted: equal words follow each other
    new[1:] = (codes[1:] != codes[:-1]) | (line[1:] != line[:-1])
    at = np.flatnonzero(new)
    lines = pa.array(np.bincount(codes[at], minlength=len(told.dictionary)).astype("i4"))
    return _row(CHUNKS, number, told.dictionary, lines, packed(codes[at]), packed(np.diff(at, append=len(codes))),
                packed(np.bincount(line[at], minlength=len(lists))), packed(table.column("copies").to_numpy()))


def numbered(block: int, row_pairs: int) -> Callable[[Batches], Batches]:
    """Chunks and the ``numbers`` of their words as rows in which words, also those of a line, are in the order of their numbers.

    A line of more than ``block`` words is there once for each block of its words, ``starts`` to ``stops``, which are those that its pairs
    are made for; a row ends after about ``row_pairs`` pairs.
    """
    def of(chunk: dict) -> Batches:
        numbers, lines = chunk["numbers"].to_numpy().astype(np.int64), chunk["sizes"]
        order = np.argsort(numbers)
        rank = np.empty(len(order), np.int64)
        rank[order] = np.arange(len(order))
        above = np.repeat(np.arange(len(lines)) * len(order), lines)
        key = above + rank[chunk["codes"]]
        by = np.argsort(key)
        codes, times = key[by] - above, chunk["times"][by]
        words, numbers = chunk["words"].take(pa.array(order)), numbers[order]
        first, n_blocks = np.cumsum(lines) - lines, -(-lines // block)
        line = np.repeat(np.arange(len(lines)), n_blocks)
        sizes, starts = lines[line], _runs(np.zeros(len(lines), np.int64), n_blocks) * block
        stops = np.minimum(starts + block, sizes)
        pairs = (stops * (stops - 1) - starts * (starts - 1)) // 2
        for a, b in _cuts(np.cumsum(pairs) // row_pairs, np.cumsum(sizes) // (2 * CHUNK_WORDS)):
            at = _runs(first[line[a:b]], sizes[a:b])
            used, places = np.unique(codes[at], return_inverse=True)
            rare = used[numbers[used] >= COMMON]
            yield _row(NUMBERED, _joined(words.take(pa.array(rare))), packed(numbers[used]), packed(places),
                       packed(times[at]), packed(sizes[a:b]), packed(chunk["copies"][line[a:b]]), packed(starts[a:b]), packed(stops[a:b]),
                       len(at), int(pairs[a:b].sum()), int(((stops - starts) * (sizes - 1))[a:b].sum()))

    return lambda batches: (out for chunk in _rows(batches) for out in of(chunk))


def dealt(tiles: int, first: int, keys: list[int], spread: int = 0) -> Callable[[Batches], Batches]:
    """What tiles ``first`` to ``first + len(keys)``, of ``tiles``, get of numbered rows: words ``x`` of lines, their times ``t`` in all
    copies of the line, and its more frequent words ``ys``, or with ``spread`` all of its words; how often each is in it, ``ns``, for those
    that are there ``twice`` or more. Both are places in ``numbers``, of which ``words`` has those from ``COMMON`` on. The partners of a
    frequent word go to ``spread`` tiles."""
    def tile(numbers: np.ndarray, part: int = 0) -> np.ndarray:
        mixed = (numbers.astype(np.uint64) * np.uint64(spread or 1) + np.uint64(part)) * np.uint64(2654435761) & np.uint64(0xFFFFFFFF)
        return (mixed * np.uint64(tiles) >> np.uint64(32)).astype(np.int64) - first

    def sent(row: dict, to: np.ndarray, at: np.ndarray, line: np.ndarray, starts: np.ndarray, sizes: np.ndarray, codes: np.ndarray,
             times: np.ndarray) -> Batches:
        """``to``: tile of each word; ``at``, ``line``: where the x are; ``starts``, ``sizes``: of what goes with each."""
        x, words, n_common = row["codes"][at], len(row["numbers"]), int(np.searchsorted(row["numbers"], COMMON))
        mine = np.flatnonzero((to[x] >= 0) & (to[x] < len(keys)) & (sizes > 0))
        mine = mine[np.argsort(to[x[mine]].astype(np.uint16 if len(keys) < 1 << 16 else np.int64), kind="stable")]
        x, starts, sizes, t = x[mine], starts[mine], sizes[mine], row["times"][at[mine]] * row["copies"][line[mine]]
        for a, b in _cuts(to[x], np.cumsum(sizes) // SENT_PAIRS):
            runs = _runs(starts[a:b], sizes[a:b])
            seen, ys, ns = np.zeros(words, bool), codes[runs], times[runs]
            seen[ys] = seen[x[a:b]] = True
            used, place = np.flatnonzero(seen), np.cumsum(seen) - 1
            place, twice = place.astype("u2" if len(used) <= 1 << 16 else "u4"), np.flatnonzero(ns > 1)
            rare = used[np.searchsorted(used, n_common):] - n_common
            yield _row(DEALT, keys[to[x[a]]], _joined(row["words"].take(pa.array(rare))), packed(row["numbers"][used]), packed(place[x[a:b]]),
                       packed(t[a:b]), packed(sizes[a:b]), packed(place[ys]), packed(twice), packed(ns[twice]))

    def of(row: dict) -> Batches:
        numbers, codes, times, sizes, n = row["numbers"], row["codes"], row["times"], row["sizes"], row["stops"] - row["starts"]
        begin, line = np.cumsum(sizes) - sizes, np.repeat(np.arange(len(sizes)), n)
        at = _runs(begin + row["starts"], n)
        if not spread:
            yield from sent(row, tile(numbers), at, line, begin[line], at - begin[line], codes, times)
            return
        often, partners = numbers[codes[at]] < (FREQUENT if spread > 1 else 0), np.where(sizes > 1, sizes, 0)
        rest, line_of_rest = at[~often], line[~often]
        yield from sent(row, tile(numbers), rest, line_of_rest, begin[line_of_rest], partners[line_of_rest], codes, times)
        at, line, of_line = at[often], line[often], np.repeat(np.arange(len(sizes)), sizes)
        for part in range(spread if len(at) else 0):
            some = numbers[codes] % spread == part
            held = np.bincount(of_line[some], minlength=len(sizes))
            yield from sent(row, tile(numbers, part), at, line, (np.cumsum(held) - held)[line], held[line], codes[some], times[some])

    return lambda batches: (out for row in _rows(batches) for out in of(row))


def _summed(x: np.ndarray, sizes: np.ndarray, y: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, ...]:
    """Rows of x with ``sizes`` partners each, as distinct x and their distinct partners with the sum of n."""
    distinct, of = np.unique(x, return_inverse=True)
    wide, deep, high = (int(a.max()).bit_length() if len(a) else 0 for a in (of, y, n))
    pair = np.repeat(of, sizes)
    pair <<= deep
    pair |= y
    if wide + deep + high < 63:  # all in one number: a plain sort
        pair <<= high
        pair |= n
        pair.sort()
        n = pair & ((1 << high) - 1)
        pair >>= high
    else:
        by = np.argsort(pair)
        pair, n = pair[by], n[by].astype(np.int64)
    new = np.ones(len(pair), bool)
    np.not_equal(pair[1:], pair[:-1], out=new[1:])
    at = np.flatnonzero(new)
    pair, n = pair[at], np.add.reduceat(n, at) if len(at) else n
    held = np.bincount(pair >> deep, minlength=len(distinct))
    pair &= (1 << deep) - 1
    return distinct[held > 0], held[held > 0], pair, n


def added(batches: Batches, common: pa.Array, whole: bool) -> Iterator[Block]:
    """The pairs of a task's tiles, each once. What has come is added up whenever it is ``BUFFER_PAIRS`` more."""
    rows, numbers, rare, words, fresh = [], [], [], [], 0
    for row in _rows(batches):
        here, sizes = row["numbers"], row["sizes"]
        x, y, n = here[row["x"]], here.astype("u4")[row["ys"]], np.repeat(row["t"], sizes)
        n[row["twice"]] *= row["ns"]
        if whole:  # a word is no partner of its own
            other = y != np.repeat(x, sizes)
            sizes = sizes - np.bincount(np.repeat(np.arange(len(x)), sizes)[~other], minlength=len(x))
            y, n = y[other], n[other]
        rows.append((x, sizes, y, n.astype("u4") if len(n) and n.max() < 1 << 32 else n))
        numbers.append(here)
        rare.append(here[here >= COMMON])
        words.append(row["words"])
        fresh += len(y)
        if fresh >= BUFFER_PAIRS:
            rows = [_summed(*map(np.concatenate, zip(*rows)))]
            numbers, (here, said), fresh = [np.unique(np.concatenate(numbers))], _named(rare, words), 0
            rare, words = [here], [said]
    if rows:
        numbers, (_, said) = np.unique(np.concatenate(numbers)), _named(rare, words)
        sums = _summed(*map(np.concatenate, zip(*rows))) if fresh else rows[0]
        yield *sums, numbers, pa.concat_arrays([common.take(pa.array(numbers[numbers < COMMON])), said])


def _named(numbers: list[np.ndarray], words: list[pa.Array]) -> tuple[np.ndarray, pa.Array]:
    distinct, at = np.unique(np.concatenate(numbers), return_index=True)
    return distinct, pa.concat_arrays(words).take(pa.array(at))


def _places(numbers: np.ndarray, some: np.ndarray) -> np.ndarray:
    """Where ``some`` are in the sorted ``numbers``."""
    if not len(numbers) or numbers[-1] >= 1 << 24:
        return np.searchsorted(numbers, some)
    table = np.zeros(numbers[-1] + 1, "i4")
    table[numbers] = np.arange(len(numbers))
    return table[some]


def _lists(values: np.ndarray, sizes: np.ndarray) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(sizes)]).astype("i4")), pa.array(values))


def as_pairs(block: Block) -> Batches:
    """Rows ``x, ys, ns``."""
    x, sizes, y, n, _, _ = block
    for a, b in _cuts(np.cumsum(sizes) >> 18):
        lo, hi = int(sizes[:a].sum()), int(sizes[:b].sum())
        yield pa.RecordBatch.from_arrays(
            [pa.array(x[a:b].astype("i4")), _lists(y[lo:hi].astype("i4"), sizes[a:b]), _lists(n[lo:hi], sizes[a:b])], ["x", "ys", "ns"])


def _letters(words: pa.Array) -> np.ndarray:
    """Length, first and last letter as one number; the first and last characters of a cleaned word are letters of one byte."""
    _, ends, data = words.buffers()
    ends = np.frombuffer(ends, "i4")[words.offset:words.offset + len(words) + 1]
    data = np.frombuffer(data, "u1").astype(np.int64) if len(words) else np.zeros(0, np.int64)
    length = pc.utf8_length(words).to_numpy(zero_copy_only=False).astype(np.int64)
    return length + 31 * data[ends[:-1]] + 1009 * data[ends[1:] - 1]


def as_sums(block: Block) -> Batches:
    """Per word, as the one and as the other of its pairs: partners, counts, the largest count, and the counts times the partner's letters."""
    x, sizes, y, n, numbers, words = block
    met = sizes > 0
    x, sizes = _places(numbers, x[met]), sizes[met]
    letters, y, starts = _letters(words), _places(numbers, y), np.cumsum(sizes) - sizes
    sums = [np.bincount(y, minlength=len(numbers)), *(np.zeros(len(numbers), np.int64) for _ in range(3))]
    np.add.at(sums[1], y, n)
    np.maximum.at(sums[2], y, n)
    np.add.at(sums[3], y, n * np.repeat(letters[x], sizes))
    if len(x):
        sums[0][x] += sizes
        sums[1][x] += np.add.reduceat(n, starts)
        sums[2][x] = np.maximum(sums[2][x], np.maximum.reduceat(n, starts))
        sums[3][x] += np.add.reduceat(n * letters[y], starts)
    met = sums[0] > 0
    yield pa.RecordBatch.from_arrays(
        [pa.array(numbers[met].astype("i4")), *(pa.array(s[met]) for s in sums)], [f.split()[0] for f in SUMS.split(", ")])


def as_stripes(parts: int) -> Callable[[Block], Batches]:
    """Maps of a word's partners to counts, a map for each part of the partners' numbers."""
    def of(block: Block) -> Batches:
        x, sizes, y, n, numbers, words = block
        part, row = y % parts, np.repeat(np.arange(len(x)), sizes)
        by = np.argsort(row * parts + part, kind="stable")
        part, row, y, n = part[by], row[by], _places(numbers, y[by]), n[by]
        runs = np.array([a for a, _ in _cuts(row, part)] + [len(row)])
        for a, b in _cuts(runs[:-1] >> 18):
            lo, hi = runs[a], runs[b]
            maps = pa.MapArray.from_arrays(pa.array((runs[a:b + 1] - lo).astype("i4")), words.take(pa.array(y[lo:hi])), pa.array(n[lo:hi]))
            yield pa.RecordBatch.from_arrays(
                [words.take(pa.array(np.searchsorted(numbers, x[row[runs[a:b]]]))), pa.array(part[runs[a:b]].astype("i4")), maps],
                ["word", "part", "stripe"])

    return of


def told(give: Callable[[Block], Batches], common: pa.Array, whole: bool = False) -> Callable[[Batches], Batches]:
    """The added-up pairs of a task, given out by ``give``. ``common``: the first words of the dictionary."""
    return lambda batches: (out for block in added(batches, common, whole) for out in give(block))
