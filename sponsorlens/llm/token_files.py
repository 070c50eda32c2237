"""Token-id files compressed by a Re-Pair grammar.

``write`` deals documents out by ranges of their id, sorts each range, encodes
the texts with the tokenizers library, appends the end id to each and writes
shards: the ids of a shard are one sequence in which frequent pairs are replaced
by nonterminals again and again, until none occurs ``LEAST`` times (a
rule takes the room of six symbols). A shard stores its rules, the expansion length of
each nonterminal, the sequence that is left, where every ``STRIDE``-th of its
symbols starts, and the ids and lengths of its documents. The manifest that
Spark writes names the files, so a repeated task leaves an unlisted file only.

``read`` gives the documents back with their ids; ``decode_range`` decodes any
stretch of a shard from the nearest stored start, without the rest.

The tokenizer's chunks, a run of whitespace and the word after it, are
independent of each other; a worker encodes each distinct one once (bounded table).
Null texts are empty. Null ids come first; rows with equal ids stay, ordered by
a hash of their text. Extra columns aren't stored.
"""
from __future__ import annotations

import os
import re
import struct
import uuid
import zlib
from collections.abc import Iterator
from itertools import chain, repeat

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from sponsorlens.session import new_dir

from .common import quiet_gc, table, worker_cache, written
from .warc import open_store

MAGIC = b"RPIDS\x02\x00\x00"
HEAD = "<8sIIQQQ"     # magic, first nonterminal, rules, symbols, documents, ids
LEAST = 8
UPPER = 128             # a round takes the pairs with a count of at least the highest one divided by this
STRIDE = 1024
SHARD_IDS = 2_000_000
TABLE_ENTRIES = 1_200_000
LONG_WORD = 64
JOINED = 256
MIX = np.uint64(0x9E3779B97F4A7C15)
SPACE = "\u0120"      # a space in the token strings of byte-level tokenizers
BLANK = r"[\s\x0b\x1c-\x1f\x{85}\p{Z}]"
ODD = BLANK + " "
APART = " |^$|" + BLANK + r"\z"


class ChunkEncoder:
    """Ids of texts from a table of distinct chunks, filled by the library."""

    def __init__(self, tokenizer: str, entries: int = TABLE_ENTRIES):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tok = Tokenizer.from_file(tokenizer)
        self.tok.no_truncation()
        self.tok.no_padding()
        self.symbols = self.tok.get_vocab_size(with_added_tokens=True)
        self.lead = np.zeros(self.symbols, bool)          # tokens that start with a space
        for t, i in self.tok.get_vocab(with_added_tokens=True).items():
            if t.startswith(SPACE):
                self.lead[i] = True
        self.entries = entries
        self.cut = re.compile(r"(?<=\S) ")
        self.clear()
        # Chunks are independent where whitespace always goes with what follows.
        for t in ("ab cd", "ab\n  cd  e \t f ", "don't  <x|y> 1 2"):
            if self.encode([t])[0].tolist() != self.plain([t])[0]:
                raise ValueError("the tokenizer joins words across whitespace")
        self.clear()

    def plain(self, texts: list[str]) -> list[list[int]]:
        return [e.ids for e in self.tok.encode_batch_fast(texts, add_special_tokens=False)]

    def clear(self) -> None:
        self.place: dict[str, int] = {}
        self.pool, self.ends = np.zeros(0, np.uint32), np.zeros(1, np.int64)

    def add(self, ids: np.ndarray, sizes: np.ndarray) -> np.ndarray:
        """Numbers of new pool entries."""
        first = len(self.ends) - 1
        self.pool = np.concatenate([self.pool, ids.astype(np.uint32)])
        self.ends = np.concatenate([self.ends, self.ends[-1] + np.cumsum(sizes, dtype=np.int64)])
        return np.arange(first, len(self.ends) - 1)

    def add_texts(self, texts: list[str]) -> np.ndarray:
        ids = self.plain(texts)
        return self.add(np.fromiter(chain.from_iterable(ids), np.uint32), np.fromiter(map(len, ids), np.int64))

    def add_words(self, words: list[str]) -> np.ndarray:
        """Numbers of the words with a space before each. Words without spaces go to the library many
        at once, and a token that starts with a space starts a word; the others go one by one."""
        number = np.empty(len(words), np.int64)
        apart = pc.match_substring_regex(pa.array(words, pa.large_string()), APART).to_numpy(zero_copy_only=False)
        alone = np.flatnonzero(apart).tolist()
        joined = np.flatnonzero(~apart)
        some = [words[i] for i in joined.tolist()] if alone else words
        sure, found, sizes = [], [], []
        blocks = [" " + " ".join(some[i : i + JOINED]) for i in range(0, len(some), JOINED)]
        for i, ids in enumerate(self.plain(blocks)):
            block = joined[i * JOINED : (i + 1) * JOINED]
            ids = np.array(ids, np.uint32)
            start = np.flatnonzero(self.lead[ids])
            if len(start) == len(block) and start[0] == 0:
                sure.append(block)
                found.append(ids)
                sizes.append(np.diff(start, append=len(ids)))
            else:
                alone += block.tolist()
        if sure:
            number[np.concatenate(sure)] = self.add(np.concatenate(found), np.concatenate(sizes))
        if alone:
            number[alone] = self.add_texts([" " + words[i] for i in alone])
        return number

    def encode(self, texts: list[str] | pa.Array) -> list[np.ndarray]:
        if len(self.ends) > self.entries or len(self.pool) > 8 * self.entries:
            self.clear()
        texts = pa.array(texts, pa.large_string()) if isinstance(texts, list) else texts.cast(pa.large_string())
        if not len(texts):
            return []
        odd = pc.match_substring_regex(texts, ODD)        # whitespace, then a space: it isn't cut there
        order = np.argsort(odd.to_numpy(zero_copy_only=False), kind="stable")
        cut = [pc.split_pattern(texts.filter(pc.invert(odd)), " "),
               pa.array([self.cut.split(t) for t in texts.filter(odd).to_pylist()], pa.list_(pa.large_string()))]
        ends = np.cumsum(np.concatenate([pc.list_value_length(c).to_numpy(zero_copy_only=False) for c in cut]).astype(np.int64))
        flat = pa.concat_arrays([c.flatten() for c in cut])
        # A text's first chunk has no space before it and is encoded as it is.
        heads = np.concatenate([[0], ends[:-1]])
        body = np.ones(len(flat), bool)
        body[heads] = False
        at = np.empty(len(flat), np.int64)
        at[heads] = self.add_texts(flat.take(pa.array(heads)).to_pylist())
        coded = flat.filter(pa.array(body)).dictionary_encode()
        words = coded.dictionary.to_numpy(zero_copy_only=False).tolist()
        number = np.fromiter(map(self.place.get, words, repeat(-1)), np.int64, len(words))
        new = np.flatnonzero(number < 0)
        if len(new):
            fresh = [words[i] for i in new]
            number[new] = self.add_words(fresh)
            self.place.update(zip(fresh, number[new].tolist()))
            for w in fresh:
                if len(w) > LONG_WORD:                    # not worth its place
                    del self.place[w]
        at[body] = number[coded.indices.to_numpy(zero_copy_only=False)]
        ids, bounds = gather(self.pool, self.ends, at)
        out: list = [None] * len(texts)
        for i, a, b in zip(order.tolist(), bounds[heads].tolist(), bounds[ends].tolist()):
            out[i] = ids[a:b]
        return out


def gather(pool: np.ndarray, ends: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Entries ``at`` of a pool (entry i ends at ends[i + 1]) one after another, and their bounds."""
    size = ends[at + 1] - ends[at]
    bounds = np.concatenate([[0], np.cumsum(size)])
    index = np.arange(bounds[-1]) + np.repeat(ends[at] - bounds[:-1], size)
    return pool[index], bounds


def encoder(tokenizer: str) -> ChunkEncoder:
    return quiet_gc(worker_cache(("chunks", tokenizer), lambda: ChunkEncoder(tokenizer)))


def re_pair(seq: np.ndarray, first: int, least: int = LEAST) -> tuple[np.ndarray, np.ndarray]:
    """(rules, rest): rule i is the pair that symbol first + i stands for.

    A round counts the pairs that may have changed or still be frequent (a pair only
    gains occurrences where a symbol of it was put in), takes those of the upper counts, and replaces them where no more frequent
    one overlaps; a rule that comes out with fewer than ``least`` uses waits for the next round. The
    most frequent pair is always replaced, so rounds go on until no pair occurs ``least`` times.
    """
    seq = seq.astype(np.uint32)
    rules: list[np.ndarray] = []
    made = first
    known, known_symbol = np.array([2**64 - 1], np.uint64), np.zeros(1, np.uint32)    # of the pairs with a rule
    alive = np.ones(len(seq), bool)               # the pair that starts here may be frequent
    while True:
        alive[-1:] = False
        at = np.flatnonzero(alive)
        left, right = seq[at], seq[at + 1]
        # Of a run of equal symbols, the first, third, ... pair counts.
        same = np.flatnonzero(left == right)
        fresh = np.diff(at[same], prepend=-2) > 1
        over = same[(at[same] - np.maximum.accumulate(np.where(fresh, at[same], 0))) % 2 == 1]
        pairs = (left.astype(np.uint64) << np.uint64(32)) | right
        ordered = np.sort(np.delete(pairs, over) if len(over) else pairs)
        edge = np.flatnonzero(ordered[1:] != ordered[:-1]) + 1
        edge = np.concatenate([np.zeros(min(len(ordered), 1), np.int64), edge])
        count = np.diff(edge, append=len(ordered))
        often = np.flatnonzero(count >= least)
        if not len(often):
            break
        # Equal counts go by the pair, so the grammar depends on the ids alone.
        best = often[np.lexsort((often, -count[often]))]
        chosen = ordered[edge[best]]
        bits = np.uint64(64 - max(12, int(4 * len(chosen)).bit_length()))
        where = np.full(1 << int(64 - bits), -1, np.int32)
        slot = (chosen * MIX >> bits).view(np.int64)
        where[slot[::-1]] = np.arange(len(chosen) - 1, -1, -1)   # a shared slot goes to the more frequent pair
        shared = np.zeros(len(chosen) + 1, bool)
        shared[where[slot[where[slot] != np.arange(len(chosen))]]] = True
        rank = where[(pairs * MIX >> bits).view(np.int64)]
        match = np.append(chosen, 0)[rank] == pairs
        match &= rank >= 0
        alive[at[~(match | shared[rank])]] = False
        match[over] = False
        match &= rank < np.searchsorted(-count[best], -(count[best[0]] // UPPER), "right")
        hit = np.flatnonzero(match)
        at, rank = at[hit], rank[hit]
        touch = np.diff(at) == 1
        lost = np.zeros(len(at), bool)
        lost[1:] |= touch & (rank[:-1] < rank[1:])
        lost[:-1] |= touch & (rank[1:] < rank[:-1])
        at, rank = at[~lost], rank[~lost]
        good = np.bincount(rank, minlength=len(chosen)) >= least
        at, rank = at[good[rank]], rank[good[rank]]
        # A pair that lost some places to others in an earlier round has its symbol already.
        symbol = np.zeros(len(chosen), np.uint32)
        old = np.searchsorted(known, chosen)
        had = known[np.minimum(old, len(known) - 1)] == chosen
        symbol[had] = known_symbol[old[had]]
        fresh = good & ~had
        pair = chosen[fresh]
        symbol[fresh] = made + np.arange(len(pair))
        made += len(pair)
        rules.append(np.stack([pair >> np.uint64(32), pair & np.uint64(0xFFFFFFFF)], 1).astype(np.uint32))
        order = np.argsort(known := np.concatenate([known, pair]))
        known, known_symbol = known[order], np.concatenate([known_symbol, symbol[fresh]])[order]
        seq[at] = symbol[rank]
        alive[at] = True
        alive[np.maximum(at - 1, 0)] = True
        keep = np.ones(len(seq), bool)
        keep[at + 1] = False
        seq, alive = seq[keep], alive[keep]
        if (good & had).any():
            again = np.zeros(made, bool)
            again[symbol[good & had]] = True
            again = again[seq]
            alive |= again
            alive[:-1] |= again[1:]
    return np.concatenate([np.zeros((0, 2), np.uint32), *rules]), seq


def expansions(rules: np.ndarray, first: int) -> tuple[np.ndarray, np.ndarray]:
    """Pool and bounds of what every symbol stands for; terminals are themselves."""
    pool, size = [np.arange(first, dtype=np.uint32)], [np.ones(first, np.int64)]
    flat, ends = pool[0], np.arange(first + 1)
    done = 0
    while done < len(rules):
        # Rules whose parts are all known are expanded together.
        known = len(ends) - 1
        ready = rules[done:].max(1) < known
        n = len(ready) if ready.all() else int(np.argmin(ready))
        parts, bounds = gather(flat, ends, rules[done : done + n].ravel().astype(np.int64))
        flat = np.concatenate([flat, parts])
        ends = np.concatenate([ends, ends[-1] + bounds[2::2]])
        done += n
    return flat, ends


def high_bits(symbols: int) -> int:
    """Bits of a symbol beyond the 16 low ones; each is stored as a plane of single bits."""
    return max(0, (symbols - 1).bit_length() - 16)


def pack(doc_ids: list, sizes: list[int], ids: np.ndarray, first: int) -> bytes:
    """One shard."""
    rules, rest = re_pair(ids, first)
    _, ends = expansions(rules, first)
    size = np.diff(ends)
    starts = np.concatenate([[0], np.cumsum(size[rest])])[:-1:STRIDE]
    planes = [np.packbits((rest >> np.uint32(16 + k) & 1).astype(bool)) for k in range(high_bits(first + len(rules)))]
    body = [rules.astype("<u4"), size[first:].astype("<u4"), starts.astype("<u8"), rest.astype("<u2"), *planes,
            np.array([d is not None for d in doc_ids], "u1"), np.array([d or 0 for d in doc_ids], "<i8"), np.array(sizes, "<u8")]
    return struct.pack(HEAD, MAGIC, first, len(rules), len(rest), len(doc_ids), len(ids)) + b"".join(x.tobytes() for x in body)


class Shard:
    """A packed shard; its parts are views of the bytes."""

    def __init__(self, data: memoryview | bytes, at: int = 0):
        magic, self.first, rules, symbols, docs, self.n_ids = struct.unpack_from(HEAD, data, at)
        if magic != MAGIC:
            raise ValueError("not a token-id shard")
        self.end = at + struct.calcsize(HEAD)

        def part(kind: str, n: int) -> np.ndarray:
            x = np.frombuffer(data, kind, n, self.end)
            self.end += x.nbytes
            return x

        self.rules = part("<u4", 2 * rules).reshape(-1, 2)
        self.size = part("<u4", rules)
        self.starts = part("<u8", -(-symbols // STRIDE))
        self.rest = part("<u2", symbols).astype(np.uint32)
        for k in range(high_bits(self.first + rules)):
            self.rest |= np.unpackbits(part("u1", -(-symbols // 8)), count=symbols).astype(np.uint32) << np.uint32(16 + k)
        there, ids = part("u1", docs), part("<i8", docs)
        self.doc_ids = [int(i) if t else None for t, i in zip(there, ids)]
        self.sizes = part("<u8", docs)

    def decode(self) -> np.ndarray:
        return gather(*expansions(self.rules, self.first), self.rest.astype(np.int64))[0]

    def decode_range(self, start: int, end: int) -> np.ndarray:
        """Ids start to end (exclusive): only the symbols between two stored starts are looked at."""
        a = max(0, int(np.searchsorted(self.starts, start, "right")) - 1)
        b = int(np.searchsorted(self.starts, end, "left"))
        symbols = self.rest[a * STRIDE : b * STRIDE].astype(np.int64)
        size = np.where(symbols < self.first, 1, self.size[np.maximum(symbols - self.first, 0)] if len(self.size) else 1)
        at = int(self.starts[a]) + np.concatenate([[0], np.cumsum(size)]) if len(self.starts) else np.zeros(1, np.int64)
        lo, hi = np.searchsorted(at, start, "right") - 1, np.searchsorted(at, end, "left")
        out: list[int] = []
        for s in symbols[lo:hi]:
            todo = [int(s)]
            while todo:
                x = todo.pop()
                if x < self.first:
                    out.append(x)
                else:
                    todo += [int(self.rules[x - self.first, 1]), int(self.rules[x - self.first, 0])]
        return np.array(out[start - int(at[lo]) : end - int(at[lo])], np.uint32)


def write(docs: DataFrame, tokenizer: str, doc_id: str = "doc_id", text: str = "text", end_id: int = 0,
          shard_ids: int = SHARD_IDS) -> DataFrame:
    """Files of the documents in ascending id order; returns the manifest (file, part, n_ids)."""
    spark = docs.sparkSession
    folder = new_dir(spark, "llm", "ids")
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    rows = docs.select(F.col(doc_id).cast("long").alias("id"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    order = (F.col("id").asc_nulls_first(), F.xxhash64("text"))
    dealt = rows.repartitionByRange(parts, *order).sortWithinPartitions(*order)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc, fs, n = encoder(tokenizer), None, 0
        held: list[np.ndarray] = []
        keys: list = []
        size = 0

        def shard():
            nonlocal held, keys, size, n
            out.write(pack(keys, [len(x) for x in held], np.concatenate(held), enc.symbols))
            n += size
            held, keys, size = [], [], 0

        for whole in batches:
            for at in range(0, whole.num_rows, 1000):
                b = whole.slice(at, 1000)
                if fs is None:
                    fs, root = open_store(folder)
                    fs.create_dir(root, recursive=True)
                    name = f"{uuid.uuid4().hex}.rpids"
                    out = fs.open_output_stream(f"{root}/{name}")
                for d, ids in zip(b.column(0).to_pylist(), enc.encode(b.column(1))):
                    held.append(np.append(ids, np.uint32(end_id)))
                    keys.append(d)
                    size += len(ids) + 1
                    if size >= shard_ids:
                        shard()
        if held:
            shard()
        if fs is not None:
            out.close()
        some = [] if fs is None else [(f"{folder}/{name}", TaskContext.get().partitionId(), n)]
        yield pa.RecordBatch.from_pydict(
            {"file": [x[0] for x in some], "part": [x[1] for x in some], "n_ids": [x[2] for x in some]},
            schema=pa.schema([("file", pa.string()), ("part", pa.int64()), ("n_ids", pa.int64())]))

    return written(dealt.mapInArrow(run, "file string, part long, n_ids long"), "manifest")


def read(manifest: DataFrame, digest: bool = False) -> DataFrame:
    """(doc_id, start, n_tokens, ids) from the files; ``digest``: the ids' crc32 as
    little-endian unsigned 32-bit integers (ids_crc32) in place of the ids."""
    spark = manifest.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    # One row for each file: a running sum over the manifest gives where a file's ids start.
    first = F.coalesce(F.sum("n_ids").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    files = manifest.select("file", first.alias("first")).repartition(parts, "file")
    last = ("ids_crc32", pa.int64()) if digest else ("ids", pa.list_(pa.int32()))
    schema = pa.schema([("doc_id", pa.int64()), ("start", pa.int64()), ("n_tokens", pa.int64()), last])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for path, start in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                fs, name = open_store(path)
                with fs.open_input_stream(name) as f:
                    data = f.read()
                at = 0
                while at < len(data):
                    s = Shard(data, at)
                    at = s.end
                    ids = s.decode().astype("<u4")
                    ends = np.cumsum(s.sizes.astype(np.int64))
                    begin = ends - s.sizes.astype(np.int64)
                    own = [ids[x:y] for x, y in zip(begin, ends)]
                    for k in range(0, len(own), 2000):
                        made = [zlib.crc32(x) for x in own[k : k + 2000]] if digest else own[k : k + 2000]
                        yield pa.RecordBatch.from_arrays([
                            pa.array(s.doc_ids[k : k + 2000], pa.int64()), pa.array(begin[k : k + 2000] + start),
                            pa.array((ends - begin)[k : k + 2000]), pa.array(made, schema.field(3).type)], schema=schema)
                    start += s.n_ids

    return files.mapInArrow(run, "doc_id long, start long, n_tokens long, " + ("ids_crc32 long" if digest else "ids array<int>"))


def op7_token_files(spark, sf_dir: str) -> DataFrame:
    import public_tokenizers

    docs = table(spark, sf_dir, "documents")
    return read(write(docs, public_tokenizers.path("byte_bpe_50k.json")), digest=True)
