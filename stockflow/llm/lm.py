"""Language-model scores of a corpus by a model that it trains itself.

A discounted bigram model, kept as Elias-Fano tries. Texts become blocks of token codes
with a dictionary each, so that shuffles carry each word once per block. Two rounds:
words meet by hash to be counted and numbered, then word pairs meet by context to be
counted, built into tries, and scored where their trie is.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stockflow.llm import words as W
from stockflow.llm.elias_fano import Trie
from stockflow.llm.warc import file_system
from stockflow.storage import drop, stored, work_path

DISCOUNT = 0.75
BLOCK_TOKENS = 1 << 19
# Tokens behind one slice of the vocabulary, and behind one trie.
SLICE_TOKENS = 6 << 20
TRIE_TOKENS = 1 << 20
# A context is cut by following word into at most so many tries.
CUTS = 4096
# Quantised: this many steps to a factor of ten, in 16 bits.
STEP = 4096
END = W.mix(np.array([0x454E44], np.uint64))[0]


def put(*arrays: np.ndarray) -> bytes:
    """Arrays as compressed bytes, each by byte planes."""
    head, body = [], []
    for array in arrays:
        head.append(f"{array.dtype.str}:{len(array)}")
        body.append(np.ascontiguousarray(array.view(np.uint8).reshape(len(array), array.itemsize).T).tobytes())
    text = ",".join(head).encode()
    return zstandard.ZstdCompressor(3).compress(len(text).to_bytes(4, "little") + text + b"".join(body))


def get(data: bytes) -> list[np.ndarray]:
    """The arrays of ``put``."""
    raw = zstandard.ZstdDecompressor().decompress(data)
    at = 4 + int.from_bytes(raw[:4], "little")
    out = []
    for part in raw[4:at].decode().split(","):
        kind, _, length = part.rpartition(":")
        dtype, count = np.dtype(kind), int(length)
        size = count * dtype.itemsize
        planes = np.frombuffer(raw, np.uint8, size, at).reshape(dtype.itemsize, count)
        out.append(np.ascontiguousarray(planes.T).view(dtype).reshape(count))
        at += size
    return out


def _deltas(values: np.ndarray) -> np.ndarray:
    return np.diff(values, prepend=values.dtype.type(0))


def _groups(batches: Iterable[pa.RecordBatch], key: str) -> Iterator[tuple[int, pa.Table]]:
    """Runs of equal keys in sorted rows, one at a time."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        if not len(batch):
            continue
        values = batch.column(key).to_numpy()
        cuts = np.r_[0, np.flatnonzero(values[1:] != values[:-1]) + 1, len(values)]
        for low, high in zip(cuts, cuts[1:], strict=False):
            part = batch.slice(low, high - low)
            if held and held[0].column(key)[0].as_py() != values[low]:
                yield held[0].column(key)[0].as_py(), pa.Table.from_batches(held)
                held = []
            held.append(part)
    if held:
        yield held[0].column(key)[0].as_py(), pa.Table.from_batches(held)


def held_out(key: object) -> bool:
    """Whether a text is kept from training, by its id as text; null counts as empty."""
    return zlib.crc32(("" if key is None else str(key)).encode()) % 5 == 1


# --- blocks -------------------------------------------------------------------


def _blocks(rows: DataFrame, kind: str, slices: int) -> DataFrame:
    """Rows of two kinds: 0 a block's codes and documents, 1 a slice of its dictionary."""

    def block(keys: list, hashed: list[np.ndarray], number: int) -> list[dict]:
        lengths = np.fromiter(map(len, hashed), np.int64, len(hashed))
        held = np.fromiter(map(held_out, keys), bool, len(keys))
        known, codes = np.unique(np.concatenate(hashed), return_inverse=True)
        train = np.bincount(codes[~np.repeat(held, lengths)], minlength=len(known))
        part = ((known >> np.uint64(32)) * np.uint64(slices)) >> np.uint64(32)
        cuts = np.searchsorted(part, np.arange(slices + 1).astype(np.uint64))
        name = (TaskContext.get().partitionId() << 24) + number
        out = [
            {
                "kind": 0,
                "block": name,
                "shard": -1,
                "ids": keys,
                "body": put(codes.astype(np.uint32), lengths.astype(np.uint32), held.view(np.uint8)),
            }
        ]
        for s in np.flatnonzero(np.diff(cuts)).tolist():
            low, high = cuts[s], cuts[s + 1]
            body = put(_deltas(known[low:high]), train[low:high].astype(np.uint32))
            out.append({"kind": 1, "block": name, "shard": s, "ids": None, "body": body})
        return out

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys, hashed, size, number = [], [], 0, 0
        for batch in batches:
            values, names = W.texts(batch.column(1)), batch.column(0).to_pylist()
            for low, high in W.slices(map(len, values), 1 << 21):
                data, offsets = W.joined(values[low:high])
                starts, ends = W.spans(data)
                words = W.hashes(data, starts, ends)
                first = np.searchsorted(starts, offsets)
                for at in range(high - low):
                    text = np.append(words[first[at] : first[at + 1]], END)
                    if size and size + len(text) > BLOCK_TOKENS:
                        yield pa.RecordBatch.from_pylist(block(keys, hashed, number), schema=schema)
                        keys, hashed, size, number = [], [], 0, number + 1
                    keys.append(names[low + at])
                    hashed.append(text)
                    size += len(text)
        if keys:
            yield pa.RecordBatch.from_pylist(block(keys, hashed, number), schema=schema)

    id_type = {"bigint": pa.int64(), "int": pa.int32(), "string": pa.string()}[kind]
    schema = pa.schema(
        [("kind", pa.int32()), ("block", pa.int64()), ("shard", pa.int32()), ("ids", pa.list_(id_type)), ("body", pa.binary())]
    )
    return rows.mapInArrow(cut, f"kind int, block bigint, shard int, ids array<{kind}>, body binary")


# --- words --------------------------------------------------------------------


def _cut_of(ids: np.ndarray) -> np.ndarray:
    return (W.mix(ids) & np.uint64(CUTS - 1)).astype(np.int64)


def _numbered(dictionaries: DataFrame, slices: int) -> DataFrame:
    """Training counts and numbers of words: for every block, in dictionary order.

    Frequent words get small numbers; 0 is a word that training lacks. Rows of block -1
    hold a slice's sums: count and distinct words by cut, for the whole vocabulary.
    """

    def number(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, table in _groups(batches, "shard"):
            blobs = [get(body) for body in table["body"].to_pylist()]
            sizes = np.array([len(b[0]) for b in blobs])
            words, times = (np.concatenate(column) for column in zip(*((np.cumsum(b[0]), b[1]) for b in blobs), strict=True))
            del blobs
            known, at = np.unique(words, return_inverse=True)
            del words
            count = np.bincount(at, times, len(known)).astype(np.int64)
            ids = np.zeros(len(known), np.uint64)
            order = np.argsort(-count, kind="stable")[: int((count > 0).sum())]
            ids[order] = np.arange(len(order), dtype=np.uint64) * np.uint64(slices) + np.uint64(part + 1)
            cuts = _cut_of(ids[order])
            sums = np.bincount(cuts, count[order], CUTS).astype(np.int64)
            words = np.bincount(cuts, minlength=CUTS)
            yield pa.RecordBatch.from_pylist(
                [{"block": -1, "shard": part, "body": None, "sums": sums, "words": words}], schema=schema
            )
            bounds = np.cumsum(sizes) - sizes
            for name, low, size in zip(table["block"].to_pylist(), bounds, sizes, strict=True):
                mine = at[low : low + size]
                body = put(ids[mine], count[mine].astype(np.uint64))
                yield pa.RecordBatch.from_pylist([{"block": name, "shard": part, "body": body}], schema=schema)

    schema = pa.schema(
        [("block", pa.int64()), ("shard", pa.int32()), ("body", pa.binary()), ("sums", pa.list_(pa.int64())),
         ("words", pa.list_(pa.int64()))]
    )
    rows = dictionaries.select("shard", "block", "body")
    rows = rows.repartition("shard").sortWithinPartitions("shard")
    return rows.mapInArrow(
        number, "block bigint, shard int, body binary, sums array<bigint>, words array<bigint>"
    )


class Model:
    """What every task knows: sums over the vocabulary, of a fixed size."""

    def __init__(self, sums: np.ndarray, words: np.ndarray, tries: int):
        self.tokens, self.words, self.tries = int(sums.sum()), int(words.sum()), tries
        self.scale = self.tokens + 0.5 * (self.words + 1)
        # Unknown words have a share too; here it goes by the known ones.
        mass = (sums + 0.5 * words) / max(1.0, float((sums + 0.5 * words).sum()))
        #: The words' probability by cut, for 1, 2, 4 … cuts.
        self.masses = [mass.reshape(-1, 1 << k).sum(0) for k in range(CUTS.bit_length())]

    def base(self, count: np.ndarray) -> np.ndarray:
        """log10 of a word's probability without context."""
        return np.log10((count + 0.5) / self.scale)

    def cuts(self, count: np.ndarray) -> np.ndarray:
        """The power of two of the cuts of a context, by its training count."""
        parts = np.maximum(count * 2.0 / TRIE_TOKENS, 1.0)
        return np.minimum(np.ceil(np.log2(parts)), CUTS.bit_length() - 1).astype(np.int64)

    def nodes(self, context: np.ndarray, power: np.ndarray, word: np.ndarray) -> np.ndarray:
        """The trie node of a context and a following word."""
        return context * np.uint64(CUTS) + (_cut_of(word) & ((1 << power) - 1)).astype(np.uint64)


# --- pairs --------------------------------------------------------------------


def _pairs(model: Model, folder: str):
    """The function of a block: its documents' sums, and its word pairs by trie.

    A pair goes to its trie once a block, however often the block has it. Which pair each
    token makes stays in a file of the block, so that no pair is hot.
    """

    def pairs(codes_row: pa.Table, numbered: pa.Table) -> pa.Table:
        codes, lengths, held = get(codes_row["body"][0].as_py())
        numbered = numbered.sort_by("shard")
        parts = [get(body) for body in numbered["body"].to_pylist()]
        ids = np.concatenate([p[0] for p in parts])[codes]
        count = np.concatenate([p[1] for p in parts]).astype(np.int64)[codes]
        lengths = lengths.astype(np.int64)
        first = np.cumsum(lengths) - lengths
        doc = np.repeat(np.arange(len(lengths)), lengths)
        base = model.base(count)
        context, seen = np.roll(ids, 1), np.roll(count, 1)
        # A text begins after an end; training has as many begins as ends.
        ends = count[first + lengths - 1]
        context[first], seen[first] = ids[first + lengths - 1], ends
        alone = seen == 0
        rest = np.bincount(doc, np.where(alone, base, 0.0), len(lengths))
        live = np.flatnonzero(~alone)
        documents = put(
            held,
            lengths.astype(np.uint32),
            np.bincount(doc[count > 0], minlength=len(lengths)).astype(np.uint32),
            np.bincount(doc, base, len(lengths)),
            rest,
            np.bincount(doc[live], minlength=len(lengths)).astype(np.uint32),
        )
        name = codes_row["block"][0].as_py()
        rows = [{"shard": -1, "block": name, "ids": codes_row["ids"][0].as_py(), "body": documents}]
        node = model.nodes(context[live], model.cuts(seen[live]), ids[live])
        shard = (W.mix(node) % np.uint64(model.tries)).astype(np.int64)
        order = np.lexsort((ids[live], node, shard))
        live, node, shard = live[order], node[order], shard[order]
        word, owner = ids[live], doc[live]
        fresh = np.r_[True, (node[1:] != node[:-1]) | (word[1:] != word[:-1])][: len(live)]
        start = np.flatnonzero(fresh)
        place = np.empty(len(live), np.uint32)
        place[order] = np.cumsum(fresh) - 1
        _write(folder, _block_file(name), put(place))
        train = np.add.reduceat((held[owner] == 0).astype(np.int64), start) if len(start) else start
        code = np.minimum(np.round(-base[live[start]] * STEP), 65535).astype(np.uint16)
        cuts = np.searchsorted(shard[start], np.arange(model.tries + 1))
        for s in np.flatnonzero(np.diff(cuts)).tolist():
            low, high = cuts[s], cuts[s + 1]
            body = put(
                _deltas(node[start[low:high]]),
                word[start[low:high]],
                train[low:high].astype(np.uint32),
                code[low:high],
                seen[live[start[low:high]]].astype(np.uint64),
            )
            rows.append({"shard": s, "block": name, "ids": None, "body": body})
        schema = pa.schema(
            [("shard", pa.int32()), ("block", pa.int64()), ("ids", codes_row.schema.field("ids").type), ("body", pa.binary())]
        )
        return pa.Table.from_pylist(rows, schema=schema)

    return pairs


def trie_of(node: np.ndarray, word: np.ndarray, train: np.ndarray, code: np.ndarray,
            seen: np.ndarray, model: Model) -> Trie:
    """The trie of the pairs that training has, with smoothed probabilities.

    Counts lose ``DISCOUNT``; what a context's words lose goes to the words of the same
    cut in proportion to their probability without context, so that each context sums
    to one.
    """
    order = np.lexsort((word, node))
    order = order[train[order] > 0]
    node, word, train, code, seen = (a[order] for a in (node, word, train, code, seen))
    start = np.flatnonzero(np.r_[True, (node[1:] != node[:-1]) | (word[1:] != word[:-1])][: len(node)])
    count = np.add.reduceat(train.astype(np.int64), start) if len(start) else start
    node, word, code, seen = node[start], word[start], code[start], seen[start].astype(np.float64)
    first = np.flatnonzero(np.r_[True, node[1:] != node[:-1]][: len(node)])
    follow = np.diff(np.r_[first, len(node)])
    weight = DISCOUNT * follow / seen[first] / _mass(node[first], seen[first], model)
    likely = np.maximum(count - DISCOUNT, 0) / seen + np.repeat(weight, follow) * 10.0 ** (code / -STEP)
    return Trie.of(np.stack([node, word + np.uint64(1)], 1), _code(likely), _code(weight / 64))


def _mass(node: np.ndarray, seen: np.ndarray, model: Model) -> np.ndarray:
    power, cut = model.cuts(seen), (node & np.uint64(CUTS - 1)).astype(np.int64)
    out = np.ones(len(node))
    for p in np.unique(power).tolist():
        at = power == p
        out[at] = model.masses[p][cut[at]]
    return np.maximum(out, 1e-300)


def _code(value: np.ndarray) -> np.ndarray:
    return np.clip(np.round(-np.log10(np.maximum(value, 1e-300)) * STEP), 0, 65535)


def scored(trie: Trie, node: np.ndarray, word: np.ndarray, code: np.ndarray,
           seen: np.ndarray, model: Model) -> np.ndarray:
    """log10 probability of each pair: its own code, or its context's weight."""
    context, at = trie.find(np.stack([node, word + np.uint64(1)], 1))
    weight = np.log10(DISCOUNT / np.maximum(seen, 1) / _mass(node, seen, model))
    has = context >= 0
    weight[has] = np.log10(64) - trie.weights[context[has]].astype(np.float64) / STEP
    out = np.minimum(weight - code / STEP, 0.0)
    found = at >= 0
    out[found] = -trie.codes[at[found]].astype(np.float64) / STEP
    return out


def _block_file(name: int) -> str:
    return f"block-{name}.pairs"


def _write(folder: str, name: str, data: bytes) -> None:
    """Write a file whole; a repeated task puts the same bytes in its place."""
    system, root = file_system(folder)
    system.create_dir(root, recursive=True)
    path = f"{root}/{name}.{TaskContext.get().taskAttemptId()}"
    with system.open_output_stream(path, compression=None) as out:
        out.write(data)
    system.move(path, f"{root}/{name}")


def _mapped(folder: str, name: str) -> np.ndarray:
    """A trie of the model's folder, mapped."""
    system, root = file_system(folder)
    if system.type_name == "local":
        return np.memmap(f"{root}/{name}", np.uint64, "r")
    with system.open_input_file(f"{root}/{name}") as file:
        return np.frombuffer(file.read_buffer(), np.uint64)


def _tries(model: Model, folder: str, schema: pa.Schema):
    """The function of sorted pairs: a trie for each shard, then the pairs' scores."""

    def tries(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for shard, table in _groups(batches, "shard"):
            if shard < 0:
                yield from table.select(schema.names).cast(schema).to_batches()
                continue
            blobs = [get(body) for body in table["body"].to_pylist()]
            node = np.concatenate([np.cumsum(b[0]) for b in blobs])
            word, train, code, seen = (np.concatenate([b[k] for b in blobs]) for k in (1, 2, 3, 4))
            ends = np.cumsum([len(b[0]) for b in blobs])[:-1]
            del blobs
            name = f"level-{shard:06d}.trie"
            _write(folder, name, trie_of(node, word, train, code, seen, model).to_bytes())
            trie = Trie.load(_mapped(folder, name))
            value = scored(trie, node, word, code, seen.astype(np.float64), model)
            parts = [put(part) for part in np.split(np.round(value * -STEP).astype(np.uint32), ends)]
            yield from pa.Table.from_arrays(
                [table["shard"], table["block"], pa.nulls(len(table), schema.field("ids").type),
                 pa.array(parts, pa.binary())],
                schema=schema,
            ).to_batches()

    return tries


def score(documents: DataFrame, id_column: str = "doc_id", text_column: str = "text",
          folder: str | None = None) -> DataFrame:
    """(id, held_out, n_tokens, n_known, train_tokens, base_score, score) of every text.

    The model learns from the texts that are not held out, all of them whole, and scores
    all. ``score`` is the log10 probability of the text's tokens and its end under the
    bigram model, ``base_score`` without context. A null or empty text is an end only; a
    null id counts as empty text where texts are held out. Repeated rows train and are
    scored each. Without training texts all words are unknown and scores are 0. Columns
    not named are not read. An empty table gives no rows.

    The tries stay in ``folder`` (a new one in the shared folder by default). A word or
    pair is sent once for each block that has it, not once an occurrence, and its score
    comes back once a block, in steps of 1 / ``STEP``; a frequent context is cut by
    following word into several tries. Slices and tries grow in number with the input,
    not in size.
    """
    spark = documents.sparkSession
    kind = documents.schema[id_column].dataType.simpleString()
    if kind not in ("bigint", "int", "string"):
        kind = "string"
    rows = documents.select(
        F.col(id_column).cast(kind).alias("id"), F.col(text_column).cast("string").alias("text")
    )
    size = rows.agg(F.sum(F.coalesce(F.octet_length("text"), F.lit(0)) + 6)).first()[0] or 0
    slices = max(1, size // (6 * SLICE_TOKENS) + 1)
    folder = folder or work_path(spark, "tries")
    table = work_path(spark, "blocks")
    _blocks(rows, kind, slices).write.partitionBy("kind").parquet(table)
    schema = f"block bigint, shard int, ids array<{kind}>, body binary, kind int"
    blocks = spark.read.schema(schema).parquet(table)
    numbered = stored(_numbered(blocks.where("kind = 1"), slices), "words")
    drop(spark, f"{table}/kind=1")
    spark.catalog.refreshByPath(table)
    blocks = spark.read.schema(schema).parquet(table)

    totals = numbered.where("block = -1")
    cuts = (
        totals.select(F.posexplode(F.arrays_zip("sums", "words")).alias("cut", "x"))
        .groupBy("cut").agg(F.sum("x.sums").alias("sums"), F.sum("x.words").alias("words"))
        .orderBy("cut").collect()
    )
    if not cuts:
        return spark.createDataFrame([], _OUT.format(kind=kind))
    model = Model(
        np.array([c["sums"] for c in cuts], np.int64),
        np.array([c["words"] for c in cuts], np.int64),
        max(1, size // (6 * TRIE_TOKENS) + 1),
    )
    codes = blocks.where("kind = 0").select("block", "ids", "body")
    pairs = codes.groupBy("block").cogroup(
        numbered.where("block >= 0").select("block", "shard", "body").groupBy("block")
    )
    tokens = work_path(spark, "tokens")
    pairs = pairs.applyInArrow(_pairs(model, tokens), f"shard int, block bigint, ids array<{kind}>, body binary")
    id_type = {"bigint": pa.int64(), "int": pa.int32(), "string": pa.string()}[kind]
    out = pa.schema(
        [("shard", pa.int32()), ("block", pa.int64()), ("ids", pa.list_(id_type)), ("body", pa.binary())]
    )
    sorted_pairs = pairs.repartition("shard", F.when(F.col("shard") < 0, F.col("block"))).sortWithinPartitions("shard")
    parts = sorted_pairs.mapInArrow(_tries(model, folder, out), f"shard int, block bigint, ids array<{kind}>, body binary")

    def summed(table: pa.Table) -> pa.Table:
        table = table.sort_by("shard")
        names, bodies = table["ids"][0].as_py(), table["body"].to_pylist()
        held, lengths, known, base, total, live = get(bodies[0])
        system, root = file_system(tokens)
        with system.open_input_file(f"{root}/{_block_file(table['block'][0].as_py())}") as file:
            (place,) = get(file.read())
        # Pairs are numbered in the order of their tries.
        value = np.concatenate([np.empty(0, np.uint32), *(get(body)[0] for body in bodies[1:])]) / -STEP
        doc = np.repeat(np.arange(len(live)), live.astype(np.int64))
        total = total + np.bincount(doc, value[place], len(live))
        return pa.table(
            {
                "id": pa.array(names, id_type),
                "held_out": pa.array(held.astype(bool)),
                "n_tokens": pa.array(lengths.astype(np.int64)),
                "n_known": pa.array(known.astype(np.int64)),
                "train_tokens": pa.array(np.full(len(held), model.tokens)),
                "base_score": pa.array(base),
                "score": pa.array(total),
            }
        )

    return parts.groupBy("block").applyInArrow(summed, _OUT.format(kind=kind))


_OUT = (
    "id {kind}, held_out boolean, n_tokens bigint, n_known bigint, train_tokens bigint, "
    "base_score double, score double"
)
