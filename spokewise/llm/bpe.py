"""BPE encoding and decoding with forced-boundary splitting.

A merge only ever builds vocabulary tokens, so two neighbouring bytes that
are neighbours inside no token can never end up in one token: between them
the text has a certain cut. Each pre-token is split at its certain cuts,
every fragment is encoded on its own (lowest merge rank first, leftmost
first among equals) and the ids are concatenated. Pre-tokens are memoised
per worker in a bounded table, which changes the speed only.

Defined results: a null text encodes like the empty text (no ids); texts
of any length are encoded whole (long ones in pieces that end before a
space which follows a non-blank, where no pre-token can reach across).
The literal strings of special tokens become their ids, as the tokenizer
file says. Extra input columns are ignored unless named in ``keep``;
repeated rows give repeated results; an empty table gives an empty one.
"""

from __future__ import annotations

import hashlib
import heapq
import json
import struct
from collections.abc import Iterable, Iterator

import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Fixed value: the pre-token pattern that the byte-level tokenizer file stands for.
PRETOKEN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"

MEMO = 500_000       # entries of a worker's memo table
ROWS = 500           # results that a worker holds at a time
PIECE = 1 << 20      # characters of a long text that are pre-tokenised at a time
LONG_FRAGMENT = 48   # from this many bytes on, merges go through a heap


def byte_letters() -> list[str]:
    """The printable letter by which the tokenizer file writes each byte."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    letters = {b: chr(b) for b in plain}
    for n, b in enumerate(b for b in range(256) if b not in letters):
        letters[b] = chr(256 + n)
    return [letters[b] for b in range(256)]


class _Memo(dict):
    """dict that computes missing entries and starts afresh when full."""

    def __init__(self, make):
        super().__init__()
        self.make = make

    def __missing__(self, key):
        if len(self) >= MEMO:
            self.clear()
        self[key] = out = self.make(key)
        return out


class Decoder:
    """Decoder of one byte-level BPE tokenizer file (its JSON text)."""

    def __init__(self, spec: bytes):
        spec = json.loads(spec)
        pre = spec["pre_tokenizer"]
        if (spec["normalizer"], spec["model"]["type"], pre["type"]) != (None, "BPE", "ByteLevel") \
                or pre["add_prefix_space"] or not pre["use_regex"]:
            raise ValueError("not a plain byte-level BPE tokenizer")
        code = {c: b for b, c in enumerate(byte_letters())}
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.bytes_of: dict[int, bytes] = {
            i: bytes(code[c] for c in t) for t, i in spec["model"]["vocab"].items() if t not in self.special}
        self._read_merges(spec["model"]["merges"], code)
        self.bytes_of.update({i: t.encode() for t, i in self.special.items()})

    def _read_merges(self, merges: list, code: dict[str, int]) -> None:
        """Decoding needs none of them."""

    def decode(self, ids: bytes) -> str:
        """Text of ids as ``encode`` gives them; special tokens are kept, ids of no token are skipped."""
        get = self.bytes_of.get
        return b"".join([get(i, b"") for i in memoryview(ids).cast("I")]).decode("utf-8", "replace")


class Codec(Decoder):
    """Encoder and decoder."""

    def _read_merges(self, merges: list, code: dict[str, int]) -> None:
        ids = {b: i for i, b in self.bytes_of.items()}
        self.byte_id = [ids[bytes([b])] for b in range(256)]
        self.rank: dict[tuple[int, int], int] = {}
        self.result: list[int] = []  # by rank
        for rank, pair in enumerate(merges):
            left, right = (bytes(code[c] for c in x) for x in (pair if isinstance(pair, list) else pair.split(" ")))
            self.rank[ids[left], ids[right]] = rank
            self.result.append(ids[left + right])
        inside = {t[k:k + 2] for t in ids for k in range(len(t) - 1)}
        self.cut_pair = [[bytes((a, b)) not in inside for b in range(256)] for a in range(256)]
        self.pretokens = _Memo(self._encode_pretoken)
        self.pattern = regex.compile(PRETOKEN)
        self.breaks = regex.compile(r"(?<=\S)(?= )")
        self.special_re = regex.compile("(" + "|".join(map(regex.escape, sorted(self.special, key=len, reverse=True)))
                                        + ")") if self.special else None

    # ---- encoding -------------------------------------------------------
    def split(self, data: bytes) -> list[bytes]:
        """``data`` at its certain cuts."""
        out, start, cut = [], 0, self.cut_pair
        for k in range(1, len(data)):
            if cut[data[k - 1]][data[k]]:
                out.append(data[start:k])
                start = k
        out.append(data[start:])
        return out

    def _encode_pretoken(self, token: str) -> bytes:
        return b"".join(map(self._encode_fragment, self.split(token.encode())))

    def _encode_fragment(self, data: bytes) -> bytes:
        ids = [self.byte_id[b] for b in data]
        ids = self._merge_long(ids) if len(ids) >= LONG_FRAGMENT else self._merge_short(ids)
        return struct.pack(f"<{len(ids)}I", *ids)

    def _merge_short(self, ids: list[int]) -> list[int]:
        rank_of, none = self.rank.get, len(self.result)
        ranks = [rank_of(p, none) for p in zip(ids, ids[1:])]
        while ranks:
            best = min(ranks)
            if best == none:
                break
            k = ranks.index(best)
            ids[k:k + 2] = [self.result[best]]
            del ranks[k]
            if k:
                ranks[k - 1] = rank_of((ids[k - 1], ids[k]), none)
            if k < len(ranks):
                ranks[k] = rank_of((ids[k], ids[k + 1]), none)
        return ids

    def _merge_long(self, ids: list[int]) -> list[int]:
        """The same merges with a heap over a linked list: n log n."""
        rank, n = self.rank, len(ids)
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        heap = [(rank[p], k, p) for k, p in enumerate(zip(ids, ids[1:])) if p in rank]
        heapq.heapify(heap)
        alive = [True] * n
        while heap:
            best, k, pair = heapq.heappop(heap)
            j = after[k] if alive[k] else n
            if j >= n or (ids[k], ids[j]) != pair:
                continue
            ids[k], alive[j], after[k] = self.result[best], False, after[j]
            if after[k] < n:
                before[after[k]] = k
            for x, y in ((before[k], k), (k, after[k])):
                if x >= 0 and y < n and (ids[x], ids[y]) in rank:
                    heapq.heappush(heap, (rank[ids[x], ids[y]], x, (ids[x], ids[y])))
        return [i for i, on in zip(ids, alive) if on]

    def _pieces(self, text: str) -> Iterator[str]:
        at = 0
        while len(text) - at > 2 * PIECE:
            m = self.breaks.search(text, at + PIECE)
            if m is None:
                break
            yield text[at:m.start()]
            at = m.start()
        yield text[at:]

    def encode(self, text: str) -> bytes:
        """Ids of ``text`` as little-endian unsigned 32-bit integers."""
        out = []
        parts = self.special_re.split(text) if self.special_re else [text]
        for n, part in enumerate(parts):
            if n % 2:
                out.append(struct.pack("<I", self.special[part]))
            else:
                for piece in self._pieces(part):
                    out.append(b"".join(map(self.pretokens.__getitem__, self.pattern.findall(piece))))
        return b"".join(out)


_CODECS: dict[tuple[type, str], Decoder] = {}


def codec(spec: bytes, kind: type = Codec) -> Decoder:
    """One codec (or decoder) per worker process and tokenizer file."""
    key = kind, hashlib.sha256(spec).hexdigest()
    if key not in _CODECS:
        _CODECS[key] = kind(spec)
    return _CODECS[key]


def _spec(df: DataFrame, path: str):
    """The tokenizer file, read once by the driver; its size is checked before it is broadcast."""
    with open(path, "rb") as f:
        data = f.read(64 << 20)
    if len(data) >= 64 << 20:
        raise ValueError("tokenizer file of 64 MiB or more")
    return df.sparkSession.sparkContext.broadcast(data)


def _map(df: DataFrame, path: str, column: str, kind: str, maker: type, fn, out: pa.Field, keep: Iterable[str]) -> DataFrame:
    keep = list(keep)
    spec = _spec(df, path)
    # helper names that cannot clash with the kept columns
    src = df.select(*[F.col(f"`{c}`") for c in keep], F.col(f"`{column}`").alias("__in"))
    schema = src.select(*[F.col(f"`{c}`") for c in keep], F.lit(None).cast(kind).alias("__out")).schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c = codec(spec.value, maker)
        for whole in batches:
            for k in range(0, whole.num_rows, ROWS):
                b = whole.slice(k, ROWS)
                values = [fn(c, x.as_py()) for x in b.column(b.num_columns - 1)]
                yield pa.RecordBatch.from_arrays([*b.columns[:-1], pa.array(values, out.type)],
                                                 names=[*b.schema.names[:-1], "__out"])

    return src.mapInArrow(run, schema)


def encode(docs: DataFrame, tokenizer: str, text: str = "text", keep: Iterable[str] = ("doc_id",),
           out: str = "ids") -> DataFrame:
    """``keep`` columns and ``out``: the ids of each text, packed little-endian unsigned 32-bit (binary)."""
    df = _map(docs, tokenizer, text, "binary", Codec, lambda c, t: c.encode(t or ""), pa.field("x", pa.binary()), keep)
    return df.withColumnRenamed("__out", out)


def decode(encoded: DataFrame, tokenizer: str, ids: str = "ids", keep: Iterable[str] = ("doc_id", "ids"),
           out: str = "decoded") -> DataFrame:
    """``keep`` columns and ``out``: the text of packed ids (null: the empty text)."""
    df = _map(encoded, tokenizer, ids, "string", Decoder, lambda c, b: c.decode(b or b""), pa.field("x", pa.string()), keep)
    return df.withColumnRenamed("__out", out)


def digests(docs: DataFrame, tokenizer: str) -> DataFrame:
    """The contract's digest columns of an encode and decode round over ``docs``."""
    both = decode(encode(docs, tokenizer), tokenizer)
    return both.select(
        "doc_id", F.floor(F.octet_length("ids") / 4).cast("long").alias("n_tokens"),
        F.sha2(F.col("ids"), 256).alias("ids_sha256"),
        F.sha2(F.encode("decoded", "UTF-8"), 256).alias("decoded_sha256"))
