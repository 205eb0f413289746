"""Language-model scores from a weighted backoff automaton of word n-grams.

States are the n-grams seen in training (the empty one is the root), an arc reads a word, and a
failure arc leads from a state to its longest proper suffix. An arc of a seen n-gram (h, w)
weighs (1 - b) c(hw) / c(h) + b P(w | suffix of h); the failure arc of h weighs b, so that the
weights of a state sum to one. b is that of h's count: of the training words read after states
of about that count, the share that no other occurrence explains (leave one out). The root's
arcs are the smoothed word shares of ``base``.

The whole automaton is never in one place. Texts are read in blocks of bounded size; a block asks
once for each of its distinct n-grams, by 64-bit hash, sending its own training counts along; the
requests, dealt evenly by hash, are summed where they meet, and the totals travel back to the
blocks that asked. From them each block makes the part of the automaton that its texts can reach:
states, sorted arcs, failure arcs and their weights. Many texts then go through it side by side,
each carrying its state from word to word. A state is told by at most ``order`` - 1 words, so a
long text goes in segments, each of which first reads that many words before it, unweighted.
Blocks wait as files in the folder that all executors share.

N-grams of equal hash would be counted as one: with d distinct ones, some d * d / 2**65 pairs.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from saleslake.llm.files import give_back_memory, read_file, write_file
from saleslake.llm.shared import id_remainder, power_of_two, store
from saleslake.session import work_dir

ORDER = 2
SMOOTHING = 0.1
BLOCK_BYTES = 32 << 20  # text of a block
BUCKETS = 48
SEGMENT = 256  # words of a text that one traverser reads
_KEY_BYTES = 6
_SPECIAL = np.array([xxhash.xxh64_intdigest(b"<%d>" % i, 7) for i in range(2)], np.uint64)  # begin, end


def _tokens(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(hash of each distinct token, the tokens as places in it, tokens per text).

    The first two hashes are those of a text's begin and end; each text's tokens end with the end.
    """
    texts = pc.ascii_lower(pc.fill_null(texts, "").cast(pa.large_string()))
    for space in "\t\n\x0b\x0c\r":
        texts = pc.replace_substring(texts, space, " ")
    words = pc.split_pattern(texts, " ")
    sizes = pc.list_value_length(words).to_numpy(zero_copy_only=False).astype(np.int64)
    coded = words.flatten().dictionary_encode()
    index = coded.indices.to_numpy(zero_copy_only=False).astype(np.int32)
    strings = coded.dictionary.to_pylist()
    hashes = np.fromiter((xxhash.xxh64_intdigest(w, 42) for w in strings), np.uint64, len(strings))
    index += 2
    if "" in strings:  # not a word: between two spaces
        real = index != strings.index("") + 2
        upto = np.r_[0, np.cumsum(real)]
        ends = np.cumsum(sizes)
        sizes = upto[ends] - upto[ends - sizes]
        index = index[real]
    index = np.insert(index, np.cumsum(sizes), np.int32(1))
    return np.r_[_SPECIAL, hashes], index, sizes + 1


def _mix(before: np.ndarray, after: np.ndarray) -> np.ndarray:
    x = before * np.uint64(0x9E3779B97F4A7C15) + after
    x ^= x >> np.uint64(31)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(29)
    return x


class _Block:
    """Texts as one row of tokens, each text opened by the begin mark, with its n-grams."""

    def __init__(self, hashes: np.ndarray, index: np.ndarray, sizes: np.ndarray, train: np.ndarray):
        starts = np.r_[0, np.cumsum(sizes)[:-1]]
        self.index = np.insert(index, starts, np.int32(0))
        self.hashes, self.sizes = hashes, sizes + 1
        self.starts = np.r_[0, np.cumsum(self.sizes)[:-1]]
        self.train = np.repeat(train, self.sizes)
        self.place = np.arange(len(self.index)) - np.repeat(self.starts, self.sizes)

    def grams(self, order: int) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray]]:
        """(n, distinct keys, key of the n-gram that ends at a token, whether there is one)."""
        keys = self.hashes[self.index]
        for n in range(1, order + 1):
            if n > 1:
                keys = np.r_[np.uint64(0), _mix(keys[:-1], self.hashes[self.index[1:]])]
            real = self.place >= n - 1
            distinct, back = np.unique(keys[real], return_inverse=True)
            where = np.full(len(keys), -1, np.int32)
            where[real] = back
            yield n, distinct, where, real

    def counts(self, distinct: np.ndarray, where: np.ndarray) -> np.ndarray:
        own = self.train & (where >= 0)
        return np.bincount(where[own], minlength=len(distinct))


def _pack_keys(keys: np.ndarray) -> bytes:
    """Sorted keys as the first and 48-bit steps; as they are where a step is larger."""
    steps = np.diff(keys)
    if len(steps) and steps.max() >= 1 << (8 * _KEY_BYTES):
        return b"\0" + keys.tobytes()
    return b"\1" + keys[:1].tobytes() + steps.view(np.uint8).reshape(-1, 8)[:, :_KEY_BYTES].tobytes()


def _unpack_keys(data: bytes) -> np.ndarray:
    if not data[0]:
        return np.frombuffer(data, np.uint64, offset=1)
    first = np.frombuffer(data, np.uint64, 1, offset=1)
    low = np.frombuffer(data, np.uint8, offset=9).reshape(-1, _KEY_BYTES)
    steps = np.zeros((len(low), 8), np.uint8)
    steps[:, :_KEY_BYTES] = low
    return np.r_[first, first + np.cumsum(steps.view(np.uint64).ravel(), dtype=np.uint64)]


def _save(folder: str, train: np.ndarray, texts: pa.Array) -> str:
    hashes, index, sizes = _tokens(texts)
    parts = [hashes.tobytes(), index.tobytes(), sizes.tobytes(), train.astype(bool).tobytes()]
    head = np.array([len(p) for p in parts], np.int64).tobytes()
    return write_file(folder, "block", zstandard.compress(head + b"".join(parts), 1))


def _load(uri: str) -> _Block:
    data = zstandard.decompress(read_file(uri))
    at = np.r_[0, np.cumsum(np.frombuffer(data, np.int64, 4))] + 32
    part = lambda i, kind: np.frombuffer(data, np.uint8, at[i + 1] - at[i], at[i]).view(kind)
    return _Block(part(0, np.uint64), part(1, np.int32), part(2, np.int64), part(3, bool))


def _blocks(docs: DataFrame, folder: str) -> DataFrame:
    """(block, ids): the file of each block and the ids of its texts, in order."""
    kind = docs.schema["id"].dataType.simpleString()

    def blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0

        def close() -> pa.RecordBatch:
            rows = pa.Table.from_batches(held).combine_chunks()
            train = rows.column(1).to_numpy()
            uri = _save(folder, train, rows.column(2).combine_chunks())
            ids = rows.column(0).combine_chunks()
            ids = pa.ListArray.from_arrays(pa.array([0, len(ids)], pa.int32()), ids)
            return pa.record_batch({"block": pa.array([uri]), "ids": ids})

        for batch in batches:
            for at in range(0, batch.num_rows, 500):
                held.append(batch.slice(at, 500))
                size += held[-1].column(2).nbytes
                if size >= BLOCK_BYTES:
                    yield close()
                    held, size = [], 0
        if held:
            yield close()
        give_back_memory()

    return docs.mapInArrow(blocks, f"block string, ids array<{kind}>")


def _requests(blocks: DataFrame, order: int, part_bits: int) -> DataFrame:
    def requests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cuts = np.arange(1, 1 << part_bits, dtype=np.uint64) << np.uint64(64 - part_bits)
        for batch in batches:
            for uri in batch.column(0).to_pylist():
                block = _load(uri)
                for n, keys, where, _ in block.grams(order):
                    counts = block.counts(keys, where)
                    at = np.r_[0, np.searchsorted(keys, cuts), len(keys)]
                    full = np.flatnonzero(np.diff(at))
                    yield pa.record_batch(
                        {
                            "block": pa.array([uri] * len(full)),
                            "part": pa.array(full.astype(np.int32)),
                            "n": pa.array(np.full(len(full), n, np.int32)),
                            "keys": pa.array([_pack_keys(keys[at[p] : at[p + 1]]) for p in full], pa.binary()),
                            "counts": pa.array([counts[at[p] : at[p + 1]].astype("<i4").tobytes() for p in full], pa.binary()),
                        }
                    )
        give_back_memory()

    return blocks.select("block").mapInArrow(requests, "block string, part int, n int, keys binary, counts binary")


def _totals(key: tuple, rows: pa.Table) -> pa.Table:
    """Answers to the requests of one part: total counts; and, under no block, of n = 1 the sums."""
    n, part = key[0].as_py(), key[1].as_py()
    keys = [_unpack_keys(k.as_py()) for k in rows.column("keys")]
    distinct, back = np.unique(np.concatenate(keys), return_inverse=True)
    counts = np.concatenate([np.frombuffer(c.as_buffer(), "<i4") for c in rows.column("counts")])
    totals = np.bincount(back, weights=counts, minlength=len(distinct)).astype(np.int64)
    ends = np.cumsum([len(k) for k in keys])
    answers = [totals[back[e - len(k) : e]].tobytes() for k, e in zip(keys, ends, strict=True)]
    word = totals[distinct != _SPECIAL[0]] if n == 1 else totals[:0]
    give_back_memory()
    return pa.table(
        {
            "block": pa.array([*rows.column("block").to_pylist(), None], pa.string()),
            "n": pa.array([n] * (len(keys) + 1), pa.int32()),
            "part": pa.array([part] * (len(keys) + 1), pa.int32()),
            "totals": pa.array([*answers, None], pa.binary()),
            "tokens": pa.array([0] * len(keys) + [int(word.sum())], pa.int64()),
            "kinds": pa.array([0] * len(keys) + [int((word > 0).sum())], pa.int64()),
        }
    )


def _answered(rows: pa.Table, order: int) -> tuple[_Block, list[tuple[np.ndarray, np.ndarray]]]:
    """A block and, for each n, the totals of its distinct n-grams and which one ends at a token."""
    block = _load(rows.column("block")[0].as_py())
    rows = rows.sort_by([("n", "ascending"), ("part", "ascending")])
    n_of = rows.column("n").to_numpy()
    out = []
    for n, keys, where, _ in block.grams(order):
        data = [t.as_py() for t in rows.column("totals").filter(pa.array(n_of == n))]
        totals = np.frombuffer(b"".join(data), np.int64)
        if len(totals) != len(keys):
            raise ValueError("answers do not match the requests of a block")
        out.append((totals, where))
    return block, out


def _bucket(counts: np.ndarray) -> np.ndarray:
    return np.minimum(np.log2(np.maximum(counts, 1)).astype(np.int64), BUCKETS - 1)


def _singles(order: int):
    """Of training tokens by n and count of the state: how many, and how many seen just there."""

    def singles(key: tuple, rows: pa.Table) -> pa.Table:
        block, grams = _answered(rows, order)
        kept = []
        for n in range(2, order + 1):
            (states, state_at), (totals, at) = grams[n - 2 : n]
            own = np.flatnonzero(block.train & (at >= 0))
            count = states[state_at[own - 1]]
            own, count = own[count >= 2], count[count >= 2]
            bucket = _bucket(count)
            once = np.bincount(bucket, weights=totals[at[own]] == 1, minlength=BUCKETS)
            every = np.bincount(bucket, minlength=BUCKETS)
            kept += [(n, b, int(every[b]), int(once[b])) for b in np.flatnonzero(every)]
        give_back_memory()
        columns = list(zip(*kept, strict=True)) or [[], [], [], []]
        kinds = [("n", pa.int32()), ("bucket", pa.int32()), ("tokens", pa.int64()), ("once", pa.int64())]
        return pa.table({name: pa.array(c, t) for (name, t), c in zip(kinds, columns, strict=True)})

    return singles


def _backoffs(rows: list, order: int) -> np.ndarray:
    """b by n and bucket; buckets that training lacks take that of the next smaller count."""
    out = np.full((order + 1, BUCKETS), 0.5)
    for n in range(2, order + 1):
        known = {r.bucket: (r.once + 0.5) / (r.tokens + 1) for r in rows if r.n == n}
        if known:
            value = known[min(known)]
            for b in range(BUCKETS):
                value = known.get(b, value)
                out[n, b] = min(max(value, 1e-4), 1 - 1e-4)
    return out


class _Automaton:
    """The states and arcs that the texts of a block can reach.

    State 0 is the root. Letters are the block's distinct words. The root has an arc for every
    letter, one of a word that training lacks leads back to it; the arcs of the other states lie
    by the hash of (state, letter), so that few are looked at to find one.
    """

    def __init__(self, grams: list[tuple[np.ndarray, np.ndarray]], tokens: int, kinds: int, backoffs: np.ndarray):
        order = len(grams)
        totals, self.letters = grams[0]
        sizes = [len(totals) for totals, _ in grams[:-1]]
        first = np.r_[1, 1 + np.cumsum(sizes, dtype=np.int64)]  # state of the first n-gram of n = 1, 2, ...
        self.n_letters = len(totals)
        self.failure = np.zeros(first[-1], np.int64)
        self.failure_weight = np.zeros(first[-1])
        weight = (totals + SMOOTHING) / (tokens + SMOOTHING * (kinds + 1))
        self.root_weight = np.log10(weight)
        self.root_next = np.where(totals > 0, first[0] + np.arange(len(totals)), 0) if order > 1 else np.zeros(len(totals), np.int64)
        arcs, weights, nexts = [np.zeros(0, np.int64)], [np.zeros(0)], [np.zeros(0, np.int32)]
        for n in range(2, order + 1):
            (states, state_at), (totals, at) = grams[n - 2 : n]
            backoff = backoffs[n][_bucket(states)]
            self.failure_weight[first[n - 2] : first[n - 1]] = np.log10(backoff)
            place = np.zeros(len(totals), np.int32)  # one place where each n-gram ends
            real = np.flatnonzero(at >= 0).astype(np.int32)
            place[at[real]] = real
            del real
            state, suffix = state_at[place - 1], state_at[place]
            weight = (1 - backoff[state]) * totals / np.maximum(states[state], 1) + backoff[state] * weight[suffix]
            to = first[n - 2] + suffix
            if n < order:
                self.failure[first[n - 1] : first[n]] = to
                to = first[n - 1] + np.arange(len(totals))
            seen = totals > 0
            arcs.append(((first[n - 2] + state) * self.n_letters + self.letters[place])[seen])
            weights.append(np.log10(weight[seen]))
            nexts.append(to[seen].astype(np.int32))
        arcs = np.concatenate(arcs)
        self.shift = np.uint64(63 - len(arcs).bit_length())
        slots = self._slot(arcs)
        by = np.argsort(slots).astype(np.int32)
        self.slots = np.searchsorted(slots[by], np.arange((1 << (64 - int(self.shift))) + 1)).astype(np.int32)
        self.arcs, self.weights, self.nexts = arcs[by], np.concatenate(weights)[by], np.concatenate(nexts)[by]

    def _slot(self, arcs: np.ndarray) -> np.ndarray:
        return ((arcs.view(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> self.shift).astype(np.int32)

    def _find(self, arcs: np.ndarray) -> np.ndarray:
        """The place of each arc; -1 where there is no such arc."""
        slot = self._slot(arcs)
        at, end = self.slots[slot], self.slots[slot + 1]
        found = np.full(len(arcs), -1, np.int32)
        left = np.flatnonzero(at < end)
        while len(left):
            here = at[left]
            hit = self.arcs[here] == arcs[left]
            found[left[hit]] = here[hit]
            at[left] += 1
            left = left[~hit & (here + 1 < end[left])]
        return found

    def read(self, states: np.ndarray, letters: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The states after one letter each, and the weights of the failure arcs and the arc taken."""
        states, to, gained = states.copy(), np.zeros(len(states), np.int64), np.zeros(len(states))
        at_root = [np.flatnonzero(states == 0)]
        going = np.flatnonzero(states)
        while len(going):
            arc = states[going] * self.n_letters + letters[going]
            found = self._find(arc)
            hit = found >= 0
            taken, found = going[hit], found[hit]
            gained[taken] += self.weights[found]
            to[taken] = self.nexts[found]
            going = going[~hit]
            gained[going] += self.failure_weight[states[going]]
            states[going] = self.failure[states[going]]
            at_root.append(going[states[going] == 0])
            going = going[states[going] != 0]
        at_root = np.concatenate(at_root)
        gained[at_root] += self.root_weight[letters[at_root]]
        to[at_root] = self.root_next[letters[at_root]]
        return to, gained

    def scores(self, block: _Block, order: int) -> np.ndarray:
        """Log10 probability of each text: traversers read one word each, step by step."""
        pieces = -(-block.sizes // SEGMENT)
        text = np.repeat(np.arange(len(pieces)), pieces)
        number = np.arange(len(text)) - np.repeat(np.cumsum(pieces) - pieces, pieces)
        length = np.minimum(block.sizes[text] - number * SEGMENT, SEGMENT)
        by = np.argsort(-length, kind="stable")  # those that still read are the first ones
        text, length = text[by], length[by]
        start = block.starts[text] + number[by] * SEGMENT
        states, total = np.zeros(len(text), np.int64), np.zeros(len(text))
        for back in range(order - 1, 0, -1):
            ready = np.flatnonzero(start - back >= block.starts[text])
            states[ready], _ = self.read(states[ready], self.letters[start[ready] - back])
        alive = np.searchsorted(-length, -np.arange(1, SEGMENT + 1), side="right")
        for step in range(SEGMENT):
            n = alive[step]
            if not n:
                break
            at = start[:n] + step
            states[:n], gained = self.read(states[:n], self.letters[at])
            total[:n] += np.where(block.place[at] > 0, gained, 0)  # the begin mark has no weight
        return np.bincount(text, weights=total, minlength=len(pieces))


def _scores(order: int, tokens: int, kinds: int, backoffs: np.ndarray):
    def scores(key: tuple, rows: pa.Table) -> pa.Table:
        block, grams = _answered(rows, order)
        automaton = _Automaton(grams, tokens, kinds, backoffs)
        counts = grams[0][0]
        del grams
        give_back_memory()
        read = block.place > 0  # the begin mark is not read
        sums = lambda x: np.add.reduceat(np.where(read, x[automaton.letters], 0), block.starts)
        out = pa.table(
            {
                "block": pa.array([key[0].as_py()]),
                "base": pa.array([sums(automaton.root_weight).tolist()], pa.list_(pa.float64())),
                "score": pa.array([automaton.scores(block, order).tolist()], pa.list_(pa.float64())),
                "known": pa.array([sums((counts > 0).astype(np.int64)).tolist()], pa.list_(pa.int64())),
                "n": pa.array([(block.sizes - 1).tolist()], pa.list_(pa.int64())),
            }
        )
        give_back_memory()
        return out

    return scores


def scored(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", folds: int = 10, order: int = ORDER
) -> DataFrame:
    """(id, held_out, n_tokens, n_known, train_tokens, base_score, score) of every row.

    Tokens are words (runs of characters other than ASCII white space, A-Z in lower case) and one
    end. The model learns from rows whose crc32(id) modulo ``folds`` is not 0. A null text is
    empty; null ids are hashed as empty texts; repeated rows count as often as they come; other
    columns are not read. With nothing to learn from, all words are equally unknown. No rows give
    no rows.
    """
    spark = docs.sparkSession
    rows = docs.select(
        F.col(id_col).alias("id"), (id_remainder(id_col, folds) != 0).alias("train"), F.col(text_col).cast("string").alias("text")
    )
    parts = power_of_two(max(16, 2 * rows.rdd.getNumPartitions()))
    blocks = store(_blocks(rows, work_dir(spark, "llm-blocks")), "blocks")
    n_blocks = max(1, blocks.count())
    requests = _requests(blocks.repartition(n_blocks), order, parts.bit_length() - 1)
    answered = requests.repartition(parts, "n", "part").groupBy("n", "part").applyInArrow(
        _totals, "block string, n int, part int, totals binary, tokens long, kinds long"
    )
    answers = store(answered, "answers")
    tokens, kinds = answers.agg(F.sum("tokens"), F.sum("kinds")).first()
    tokens, kinds = tokens or 0, kinds or 0
    own = answers.where("block IS NOT NULL").select("block", "n", "part", "totals").repartition(n_blocks, "block")
    seen = own.groupBy("block").applyInArrow(_singles(order), "n int, bucket int, tokens long, once long")
    seen = seen.groupBy("n", "bucket").agg(F.sum("tokens").alias("tokens"), F.sum("once").alias("once")).collect()
    lists = own.groupBy("block").applyInArrow(
        _scores(order, tokens, kinds, _backoffs(seen, order)),
        "block string, base array<double>, score array<double>, known array<long>, n array<long>",
    )
    zipped = lists.join(blocks, "block").select(F.explode(F.arrays_zip("ids", "base", "score", "known", "n")).alias("x"))
    return zipped.select(
        F.col("x.ids").alias(id_col),
        (id_remainder("x.ids", folds) == 0).alias("held_out"),
        F.col("x.n").alias("n_tokens"),
        F.col("x.known").alias("n_known"),
        F.lit(tokens).cast("long").alias("train_tokens"),
        F.col("x.base").alias("base_score"),
        F.col("x.score").alias("score"),
    )
