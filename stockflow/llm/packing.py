"""Token ids packed into rows of fixed length, written as binary matrices."""

from __future__ import annotations

import base64
import hashlib
import os
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stockflow.llm import words as W
from stockflow.llm.warc import file_system
from stockflow.storage import work_path

TOKENIZER = "/opt/tokenizers/byte_bpe_50k.tiktoken"
# How the byte-level tokenizer cuts text, and its free id.
PATTERN = (
    r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
)
END = 50256
LENGTH = 2048
# Tokens that are packed together; more would fill the last rows only a little better.
GROUP_TOKENS = 4 << 20
# White space outside ASCII.
_WIDE_SPACE = re.compile(f"[{''.join(map(chr, (0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000)))}]")


class Tokenizer:
    """Token ids of texts, the end id after each. Equal words are encoded once."""

    def __init__(self, path: str, pattern: str = PATTERN, end: int = END):
        import tiktoken

        with open(path, "rb") as lines:
            ranks = {
                base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)
            }
        self.end = end
        self.dtype = np.uint16 if max(end, *ranks.values()) < 1 << 16 else np.uint32
        self.encoding = tiktoken.Encoding(
            os.path.basename(path), pat_str=pattern, mergeable_ranks=ranks, special_tokens={}
        )

    def encode(self, values: list[bytes]) -> list[np.ndarray]:
        """The ids of each text.

        A token never runs from a word into the white space behind it, so a text may be
        cut before each run of white space; white space outside ASCII spoils that, and
        such a text is encoded whole.
        """
        data, offsets = W.joined(values, lower=False)
        starts, ends = W.spans(data)
        # A piece is the white space before a word, and the word; a text's end is one too.
        first = np.searchsorted(starts, offsets)
        count = np.diff(first)
        cut = np.empty(len(starts) + len(values), np.int64)
        place = np.arange(len(starts)) + np.repeat(np.arange(len(values)), count)
        cut[place] = ends
        last = first[1:] + np.arange(len(values))
        cut[last] = offsets[1:] - 1
        begin = np.empty_like(cut)
        begin[1:] = cut[:-1]
        heads = first[:-1] + np.arange(len(values))
        begin[heads] = offsets[:-1]
        hashed = W.hashes(data, begin, cut)
        _, where, which = np.unique(hashed, return_index=True, return_inverse=True)
        view = data.tobytes()
        encode = self.encoding.encode_ordinary
        pieces = [
            encode(view[a:b].decode())
            for a, b in zip(begin[where].tolist(), cut[where].tolist(), strict=True)
        ]
        lengths = np.fromiter(map(len, pieces), np.int64, len(pieces))
        flat = np.fromiter((t for p in pieces for t in p), self.dtype, int(lengths.sum()))
        starts_of = np.cumsum(lengths) - lengths
        ids = flat[W.ragged(starts_of[which], lengths[which])]
        bounds = np.concatenate(([0], np.cumsum(lengths[which])))
        out = []
        for at, text in enumerate(values):
            part = ids[bounds[heads[at]] : bounds[last[at] + 1]]
            if not text.isascii() and _WIDE_SPACE.search(text.decode()):
                part = np.array(encode(text.decode()), self.dtype)
            out.append(np.append(part, self.dtype(self.end)))
        return out


class Capacities:
    """A segment tree over free places: which open row fits most tightly.

    A leaf for each number of free places holds the rows that have it; a node knows
    whether any leaf below it is taken.
    """

    def __init__(self, length: int):
        self.base = 1 << length.bit_length()
        self.taken = bytearray(2 * self.base)
        self.rows: list[list[int]] = [[] for _ in range(self.base)]

    def add(self, free: int, row: int) -> None:
        self.rows[free].append(row)
        node = self.base + free
        while node and not self.taken[node]:
            self.taken[node] = 1
            node >>= 1

    def take(self, need: int) -> tuple[int, int] | None:
        """The row with the least free places that are enough, and how many they are."""
        node, taken = self.base + need, self.taken
        if not taken[node]:
            while node > 1 and (node & 1 or not taken[node + 1]):
                node >>= 1
            if node <= 1:
                return None
            node += 1
            while node < self.base:
                node = 2 * node if taken[2 * node] else 2 * node + 1
        free = node - self.base
        row = self.rows[free].pop()
        if not self.rows[free]:
            taken[node] = 0
            node >>= 1
            while node and not (taken[2 * node] or taken[2 * node + 1]):
                taken[node] = 0
                node >>= 1
        return row, free


def best_fit(lengths: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray]:
    """Row and order of each segment: longest first, each into the tightest open row."""
    order = np.argsort(-lengths, kind="stable")
    row = np.empty(len(lengths), np.int64)
    tree, rows = Capacities(capacity), 0
    for at, need in zip(order.tolist(), lengths[order].tolist(), strict=True):
        found = tree.take(need)
        if found is None:
            found, rows = (rows, capacity), rows + 1
        row[at] = found[0]
        if found[1] > need:
            tree.add(found[1] - need, found[0])
    return row, order


def pack(ids: list[np.ndarray], length: int, pad: int, dtype) -> tuple:
    """(matrix, cumulative lengths by row, (text, first token) of each segment by row).

    A text longer than a row is cut into full rows and a rest; nothing is lost.
    """
    sizes = np.fromiter(map(len, ids), np.int64, len(ids))
    parts = -(-sizes // length)
    text = np.repeat(np.arange(len(ids)), parts)
    offset = W.ragged(np.zeros(len(ids), np.int64), parts) * length
    lengths = np.minimum(sizes[text] - offset, length)
    row, order = best_fit(lengths, length)
    by_row = order[np.argsort(row[order], kind="stable")]
    matrix = np.full((int(row.max(initial=-1)) + 1, length), pad, dtype)
    cumulative, origin = [[0] for _ in matrix], [[] for _ in matrix]
    for at in by_row.tolist():
        r, t, o, n = int(row[at]), int(text[at]), int(offset[at]), int(lengths[at])
        start = cumulative[r][-1]
        matrix[r, start : start + n] = ids[t][o : o + n]
        cumulative[r].append(start + n)
        origin[r].append((t, o))
    return matrix, cumulative, origin


def positions(cumulative: list[int], length: int) -> np.ndarray:
    """Positions of a row that start again at each segment; the padding is one too."""
    cuts = np.array([*cumulative, length])
    return np.arange(length) - np.repeat(cuts[:-1], np.diff(cuts))


def _write(system, path: str, data: bytes) -> None:
    """Write to a name of the attempt, then move it over: a repeated task is harmless."""
    draft = f"{path}.{TaskContext.get().taskAttemptId()}"
    with system.open_output_stream(draft) as out:
        out.write(data)
    system.move(draft, path)


SCHEMA = (
    "file string, row bigint, n_tokens bigint, doc_ids array<{id}>, first_tokens array<bigint>, "
    "cumulative array<int>, resets array<int>, ids_sha256 string"
)


def write_packed(documents: DataFrame, folder: str | None = None, id_column: str = "doc_id",
                 text_column: str = "text", tokenizer: str = TOKENIZER, length: int = LENGTH,
                 pattern: str = PATTERN, end: int = END) -> DataFrame:
    """Write documents as packed token ids; returns a row for each packed row.

    Every group of documents of a task becomes three files in ``folder`` (a new one in
    the shared folder by default): ``….ids`` is a row-major matrix of ``length`` ids
    (16 bits where the ids fit, else 32, little endian, filled up with the end id);
    ``….cu`` the cumulative segment lengths of all rows (32 bits, each row from 0);
    ``….pos`` the positions of all places (same shape as the ids, 16 or 32 bits).
    Returned: file, row, used places, document and first token of each segment,
    cumulative lengths, places where positions start again, SHA-256 of the row's ids.

    Each text ends with the end id, so a null or empty text is one token. Longer texts
    are cut into full rows and a rest. Repeated rows are packed each. Of equally long
    segments the earlier goes first. Other columns are not read. An empty table gives
    no rows and no files. Documents are packed where they are read: nothing is shuffled,
    and a task holds ``GROUP_TOKENS`` tokens, or one longer text.
    """
    target = folder or work_path(documents.sparkSession, "packed")
    kind = documents.schema[id_column].dataType.simpleString()
    rows = documents.select(
        F.col(id_column).alias("id"), F.col(text_column).cast("string").alias("text")
    )

    def groups(batches, tok) -> Iterator[tuple[list, list]]:
        keys, ids, size = [], [], 0
        for batch in batches:
            values, names = W.texts(batch.column(1)), batch.column(0).to_pylist()
            for low, high in W.slices(map(len, values), 1 << 21):
                for name, one in zip(names[low:high], tok.encode(values[low:high]), strict=True):
                    if size and size + len(one) > GROUP_TOKENS:
                        yield keys, ids
                        keys, ids, size = [], [], 0
                    keys.append(name)
                    ids.append(one)
                    size += len(one)
        if keys:
            yield keys, ids

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tok = Tokenizer(tokenizer, pattern, end)
        system, root = file_system(target)
        system.create_dir(root, recursive=True)
        small = np.uint16 if length <= 1 << 16 else np.uint32
        for at, (keys, ids) in enumerate(groups(batches, tok)):
            name = f"part-{TaskContext.get().partitionId():06d}-{at:04d}"
            matrix, cumulative, origin = pack(ids, length, end, tok.dtype)
            _write(system, f"{root}/{name}.ids", matrix.tobytes())
            flat = np.fromiter((c for row in cumulative for c in row), np.int32)
            _write(system, f"{root}/{name}.cu", flat.tobytes())
            places = b"".join(positions(row, length).astype(small).tobytes() for row in cumulative)
            _write(system, f"{root}/{name}.pos", places)
            yield pa.RecordBatch.from_pylist(
                [
                    {
                        "file": name,
                        "row": r,
                        "n_tokens": cumulative[r][-1],
                        "doc_ids": [keys[t] for t, _ in origin[r]],
                        "first_tokens": [o for _, o in origin[r]],
                        "cumulative": cumulative[r],
                        "resets": cumulative[r][:-1],
                        "ids_sha256": hashlib.sha256(matrix[r].tobytes()).hexdigest(),
                    }
                    for r in range(len(matrix))
                ],
                schema=out_schema,
            )

    schema = SCHEMA.format(id=kind)
    id_type = {"bigint": pa.int64(), "int": pa.int32()}.get(kind, pa.string())
    out_schema = pa.schema(
        [
            ("file", pa.string()), ("row", pa.int64()), ("n_tokens", pa.int64()),
            ("doc_ids", pa.list_(id_type)), ("first_tokens", pa.list_(pa.int64())),
            ("cumulative", pa.list_(pa.int32())), ("resets", pa.list_(pa.int32())),
            ("ids_sha256", pa.string()),
        ]
    )
    return rows.mapInArrow(write, schema)


def read_packed(folder: str, length: int = LENGTH, dtype=np.uint16) -> Iterator[tuple[str, np.ndarray, np.ndarray, np.ndarray]]:
    """(file, ids, cumulative, positions) of each group, mapped from local files."""
    for name in sorted(n[:-4] for n in os.listdir(folder) if n.endswith(".ids")):
        path = os.path.join(folder, name)
        ids = np.memmap(f"{path}.ids", dtype, "r").reshape(-1, length)
        small = np.uint16 if length <= 1 << 16 else np.uint32
        places = np.memmap(f"{path}.pos", small, "r").reshape(-1, length)
        yield name, ids, np.fromfile(f"{path}.cu", np.int32), places
