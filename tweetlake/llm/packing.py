"""Best-fit packing by a configuration linear program over the length histogram.

1. Every text becomes token ids (white-space chunks are encoded once and remembered, which
   gives the ids of the whole text because the tokenizer never joins across white space) and
   is cut into pieces of at most ``capacity`` ids only if longer.
2. The histogram of piece lengths (at most ``capacity`` rows) is solved on the driver: the
   linear program over ways to fill a sequence is approximated by multiplicative weights, each
   step priced by a knapsack over the weights; the fractional counts are rounded down to whole
   sequences, filled up to ``1 - loose`` by the program; what is left is packed best-fit, longest first.  All of it is run-length:
   (way to fill, how often), so its size follows the lengths and not the rows.
3. A piece finds its place from its rank among the pieces of its length.  Ranks are counted
   per partition first, so a length that a great many pieces share is not ranked in one task.

Defined results: a null or empty text is the closing id alone; repeated rows are packed each
for itself; an empty table gives an empty result; other columns do not enter.
"""

from __future__ import annotations

import math
import unicodedata
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tweetlake.llm.common import cut, remember, ship

CAPACITY, CLOSING_ID = 4096, 1
#: What is remembered: the present and the former generation; what is met again moves up.
_CHUNKS: dict[bytes, bytes] = {}
_CHUNKS_BEFORE: dict[bytes, bytes] = {}
_WORDS: dict[str, bytes] = {}
_WORDS_BEFORE: dict[str, bytes] = {}
GENERATION = 500_000
_TOKENIZERS: dict[str, tuple] = {}
_PLAIN = frozenset(".,;:!?#*$%&|-")
_FAR = 1 << 42


def default_tokenizer() -> str:
    import public_tokenizers
    return public_tokenizers.path("word_bpe_49k.json")


def _tokenizer(path: str) -> tuple:
    """The tokenizer, and which ids end a word; other paths' memories are dropped."""
    if path not in _TOKENIZERS:
        from tokenizers import Tokenizer
        for memo in (_TOKENIZERS, _CHUNKS, _CHUNKS_BEFORE, _WORDS, _WORDS_BEFORE):
            memo.clear()
        t = Tokenizer.from_file(path)
        vocab = t.get_vocab()
        ends = np.zeros(max(vocab.values()) + 1, dtype=bool)
        ends[[i for w, i in vocab.items() if w.endswith("</w>")]] = True
        _TOKENIZERS[path] = t, ends
    return _TOKENIZERS[path]


def _words(chunk: str) -> tuple[str, ...] | None:
    """The words that the tokenizer sees in a plain chunk; None for chunks that it must split."""
    low = chunk.lower()
    if "\u03a3" in chunk or not (low.isascii() or unicodedata.is_normalized("NFC", low)):
        return None
    if low.isalpha():
        return (low,)
    if low[:-1].isalpha() and low[-1] in _PLAIN:
        return low[:-1], low[-1]
    return (low,) if _PLAIN.issuperset(low) else None


def _unknown(keys: set, now: dict, before: dict) -> set:
    """The keys of neither generation; those of the former move to the present."""
    out = set()
    for k in keys:
        if k not in now:
            v = before.get(k)
            if v is None:
                out.add(k)
            else:
                now[k] = v
    return out


def _learn(chunks: list[bytes], path: str) -> None:
    """Remember the ids of chunks: unseen words are encoded together and parted at word ends."""
    t, ends = _tokenizer(path)
    split = {c: _words(c.decode()) for c in chunks}
    new = list(_unknown({w for ws in split.values() if ws for w in ws}, _WORDS, _WORDS_BEFORE))
    odd = [c for c, ws in split.items() if ws is None]
    for i in range(0, len(new), 1000):
        group = new[i:i + 1000]
        ids = np.array(t.encode_batch_fast([" ".join(group)], add_special_tokens=False)[0].ids, dtype="<u4")
        at = np.flatnonzero(ends[ids]) + 1
        if len(at) == len(group) and (not len(at) or at[-1] == len(ids)):
            raw, lo = ids.tobytes(), 0
            for w, hi in zip(group, (4 * at).tolist(), strict=True):
                _WORDS[w] = raw[lo:hi]
                lo = hi
        else:
            for w, e in zip(group, t.encode_batch_fast(group, add_special_tokens=False), strict=True):
                _WORDS[w] = np.array(e.ids, dtype="<u4").tobytes()
    for c, e in zip(odd, t.encode_batch_fast([c.decode() for c in odd], add_special_tokens=False), strict=True):
        _CHUNKS[c] = np.array(e.ids, dtype="<u4").tobytes()
    for c, ws in split.items():
        if ws:
            _CHUNKS[c] = _WORDS[ws[0]] if len(ws) == 1 else _WORDS[ws[0]] + _WORDS[ws[1]]


def token_bytes(texts: list[str], path: str) -> list[bytes]:
    """Each text's ids and the closing id as little-endian unsigned 32-bit numbers."""
    remember("tokens", _CHUNKS, _CHUNKS_BEFORE, _WORDS, _WORDS_BEFORE)
    _tokenizer(path)
    for now, before in ((_CHUNKS, _CHUNKS_BEFORE), (_WORDS, _WORDS_BEFORE)):
        if len(now) > GENERATION:
            before.clear()
            before.update(now)
            now.clear()
    split = [t.encode().split() for t in texts]
    found = [list(map(_CHUNKS.get, chunks)) for chunks in split]
    gaps = [[i for i, part in enumerate(parts) if part is None] for parts in found]
    new = _unknown({chunks[i] for chunks, at in zip(split, gaps) for i in at}, _CHUNKS, _CHUNKS_BEFORE)
    if new:
        _learn(list(new), path)
    for chunks, parts, at in zip(split, found, gaps):
        for i in at:
            parts[i] = _CHUNKS[chunks[i]]
    end = CLOSING_ID.to_bytes(4, "little")
    return [b"".join(parts) + end for parts in found]


def pieces(docs: DataFrame, path: str, capacity: int = CAPACITY, with_ids: bool = False) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32 (and the ids if asked for): one row per piece."""
    ship(docs.sparkSession)

    names = ["doc_id", "piece", "start", "length", "ids_crc32"] + ["ids"] * with_ids

    def cut_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 100):
                some = batch.slice(at, 100)
                rows = []
                for doc, raw in enumerate(token_bytes([t or "" for t in some.column("t").to_pylist()], path)):
                    for k, low in enumerate(range(0, len(raw), 4 * capacity)):
                        ids = raw[low:low + 4 * capacity]
                        rows.append((doc, k, low // 4, len(ids) // 4, zlib.crc32(ids)) + ((ids,) if with_ids else ()))
                doc, *rest = zip(*rows)
                kinds = [pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.binary()]
                # Ids stay in Arrow: a null beside them would turn large ones into other numbers in pandas.
                yield pa.RecordBatch.from_arrays([some.column("doc_id").take(pa.array(doc)),
                                                  *(pa.array(x, kind) for x, kind in zip(rest, kinds))], names)

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").alias("t")).mapInArrow(
        cut_up, "doc_id long, piece int, start long, length long, ids_crc32 long" + ", ids binary" * with_ids)


def _knapsack(value: np.ndarray, size: int) -> np.ndarray:
    """The most valuable multiset of classes 1..size (of sizes 1..size) within ``size``."""
    best, pick = np.zeros(size + 1), np.zeros(size + 1, dtype=np.int64)
    back = np.zeros(size + 1)  # best, from the far end: back[size - c] = best[c]
    for c in range(1, size + 1):
        total = value[1:c + 1] + back[size - c + 1:size + 1]
        k = int(total.argmax())
        if total[k] > best[c - 1]:
            best[c], pick[c] = total[k], k + 1
        else:
            best[c] = best[c - 1]
        back[size - c] = best[c]
    counts = np.zeros(size + 1, dtype=np.int64)
    c = size
    while c > 0:
        if pick[c]:
            counts[pick[c]] += 1
            c -= pick[c]
        else:
            c -= 1
    return counts


def configuration_lp(demand: np.ndarray, step: float = 0.1, rate: float = 6.0,
                     max_steps: int = 4000) -> list[tuple[np.ndarray, float]]:
    """Ways to fill a sequence and how often, covering ``demand`` (by class = size) fractionally.

    A class's weight falls exponentially with the share of it that is covered; the priced way
    is used until some class of it is covered by ``step`` more.
    """
    size = len(demand) - 1
    need = demand.astype(float)
    covered = np.zeros(size + 1)
    found: dict[bytes, tuple[np.ndarray, float]] = {}
    has = need > 0
    for _ in range(max_steps):
        open_ = has & (covered < need * (1 - 1e-9))
        if not open_.any():
            break
        share = np.where(has, covered / np.where(has, need, 1), 1)
        # Value by token: covered tokens are worth their size, uncovered ones more of it.
        value = np.where(open_, np.arange(size + 1) * np.exp(-rate * share), -1.0)
        way = _knapsack(value, size)
        used = way > 0
        if not used.any():
            break
        times = float(np.min(np.minimum(need[used] * step, need[used] - covered[used]) / way[used]))
        times = max(times, 1e-6)
        covered += times * way
        key = way.tobytes()
        found[key] = (way, found.get(key, (way, 0.0))[1] + times)
    return sorted(found.values(), key=lambda x: -x[1])


def solve(histogram: dict[int, int], capacity: int = CAPACITY, grain: int = 16,
          loose: float = 0.02) -> list[tuple[tuple[int, ...], int]]:
    """(lengths in a sequence, how many such sequences) that hold each length as often as given."""
    rest = {n: int(c) for n, c in histogram.items() if c > 0}
    ways: list[tuple[tuple[int, ...], int]] = []
    if rest.get(capacity):
        ways.append(((capacity,), rest.pop(capacity)))
    size = capacity // grain
    pools: list[list[list[int]]] = [[] for _ in range(size + 1)]
    for n in sorted(rest, reverse=True):
        k = -(-n // grain)
        if k <= size:
            pools[k].append([n, rest[n]])
    left = np.array([sum(c for _, c in p) for p in pools], dtype=np.int64)
    started: list[tuple[tuple[int, ...], int]] = []
    for way, times in configuration_lp(left):
        # Classes are rounded up to the grain, which leaves gaps of up to a few hundredths: of a fuller
        # way the smallest pieces are left to best fit, which closes such gaps to the token.
        way, used = way.copy(), np.flatnonzero(way)
        while len(used) and (way * np.arange(size + 1)).sum() > (1 - loose) * size:
            way[used[0]] -= 1
            used = np.flatnonzero(way)
        if not len(used):
            continue
        whole = int(min(math.floor(times), (left[used] // way[used]).min()))
        if whole < 1:
            continue
        left -= whole * way
        slots = [k for k in used for _ in range(way[k])]
        runs = []
        for k in slots:
            want, run = whole, []
            while want:
                n, c = pools[k][0]
                take = min(c, want)
                run.append([n, take])
                want -= take
                rest[n] -= take
                pools[k][0][1] -= take
                if not pools[k][0][1]:
                    pools[k].pop(0)
            runs.append(run)
        while runs[0]:
            take = min(run[0][1] for run in runs)
            started.append((tuple(run[0][0] for run in runs), take))
            for run in runs:
                run[0][1] -= take
                if not run[0][1]:
                    run.pop(0)
    # Best fit, longest first, into what is started and then into new sequences.
    room: list[list[list]] = [[] for _ in range(capacity + 1)]
    open_ = np.zeros(capacity + 1, dtype=bool)
    def put(lengths, times):
        free = capacity - sum(lengths)
        room[free].append([lengths, times])
        open_[free] = True
    for lengths, times in started:
        put(lengths, times)
    for n in sorted((n for n, c in rest.items() if c), reverse=True):
        count = rest[n]
        while count:
            at = n + int(open_[n:].argmax()) if open_[n:].any() else -1
            if at < 0:
                each = capacity // n
                if count >= each:
                    put((n,) * each, count // each)
                    count %= each
                if count:
                    put((n,) * count, 1)
                break
            lengths, times = room[at][-1]
            take = min(times, count)
            if take == times:
                room[at].pop()
                open_[at] = bool(room[at])
            else:
                room[at][-1][1] -= take
            put(lengths + (n,), take)
            count -= take
    return ways + [(tuple(lengths), times) for group in room for lengths, times in group]


def places(ways: list[tuple[tuple[int, ...], int]]) -> dict[str, np.ndarray]:
    """For each (length, way): first rank, first sequence, copies per sequence and their offset."""
    rows, seen, sequence = [], {}, 0
    for lengths, times in ways:
        offset = 0
        for n in sorted(set(lengths), reverse=True):
            copies = lengths.count(n)
            rows.append((n, seen.get(n, 0), sequence, copies, offset))
            seen[n] = seen.get(n, 0) + copies * times
            offset += n * copies
        sequence += times
    rows.sort()
    table = np.array(rows, dtype=np.int64).reshape(-1, 5)
    return {"key": table[:, 0] * _FAR + table[:, 1], "first": table[:, 1], "sequence": table[:, 2],
            "copies": table[:, 3], "offset": table[:, 4]}


def pack(docs: DataFrame, path: str | None = None, capacity: int = CAPACITY) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32, sequence_id and offset of every piece."""
    # Partitions are fixed from the cut on: ranks count by them.
    df = cut(pieces(docs, path or default_tokenizer(), capacity)).withColumn("_part", F.spark_partition_id())
    counts = cut(df.groupBy("length", "_part").agg(F.count(F.lit(1)).alias("n")))
    histogram = {r["length"]: r["n"] for r in counts.groupBy("length").agg(F.sum("n").alias("n")).collect()}
    found = places(solve(histogram, capacity))
    shared = docs.sparkSession.sparkContext.broadcast(found)  # follows the lengths, not the rows
    before = Window.partitionBy("length").orderBy("_part")
    base = counts.select("length", "_part", (F.sum("n").over(before) - F.col("n")).alias("_base"))
    inside = F.row_number().over(Window.partitionBy("length", "_part").orderBy("doc_id", "piece", "ids_crc32"))
    ranked = (df.withColumn("_rank", inside - 1).join(base, ["length", "_part"])
              .select("doc_id", "piece", "start", "length", "ids_crc32", (F.col("_rank") + F.col("_base")).alias("rank")))

    def placed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        t = shared.value
        for batch in batches:
            n, rank = batch.column("length").to_numpy(), batch.column("rank").to_numpy()
            i = np.searchsorted(t["key"], n * _FAR + rank, side="right") - 1
            q = rank - t["first"][i]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:-1], pa.array(t["sequence"][i] + q // t["copies"][i]), pa.array(t["offset"][i] + q % t["copies"][i] * n)],
                [*batch.schema.names[:-1], "sequence_id", "offset"])

    return ranked.mapInArrow(placed, "doc_id long, piece int, start long, length long, ids_crc32 long, "
                                     "sequence_id long, offset long")
