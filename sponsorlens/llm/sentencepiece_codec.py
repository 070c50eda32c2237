"""SentencePiece encoding and decoding through a distinct-chunk table.

In a model whose pieces hold the whitespace marker only at their start, no
merge can join a character to a marker that follows it. The marked text then
falls into chunks, each a run of markers and the word after it, that are
segmented independently. Each task segments every distinct chunk once, with
the library, into a table; the ids of a text are the table's entries joined in
the order of its chunks. The table is bounded: when it is full it starts anew.

Null texts count as empty; an empty text has no ids and decodes to "". Texts of
any length are cut at markers, never truncated. Repeated rows stay; other
columns pass through, and one named like an output column is replaced by it.
"""
from __future__ import annotations

import re
from itertools import chain

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import add_columns, quiet_gc, table

MARK = "▁"
TABLE_ENTRIES = 250_000
LONG_CHUNK = 64          # longer chunks (no whitespace inside) aren't worth keeping


class ChunkTable:
    """Distinct marked chunk -> ids, filled by the library."""

    def __init__(self, model: str, entries: int = TABLE_ENTRIES):
        import sentencepiece

        self.sp = sentencepiece.SentencePieceProcessor(model_file=model)
        self.entries = entries
        self.ids: dict[str, tuple] = {}
        self.runs = re.compile(f"{MARK}+[^{MARK}]*")
        crossing = re.compile(f"[^{MARK}]{MARK}")
        pieces = [self.sp.id_to_piece(i) for i in range(self.sp.get_piece_size())]
        ok = self.sp.piece_to_id(MARK) != self.sp.unk_id() and self.sp.encode("a b ", out_type=str) == (
            [p for w in (f"{MARK}a", f"{MARK}b") for p in self.sp.encode(w[1:], out_type=str)] + [MARK])
        #: False: pieces may cross a marker, or texts are normalised; whole texts are encoded then.
        self.separable = ok and not any(map(crossing.search, pieces)) and self.sp.normalize("a  Ａ") == f"{MARK}a{MARK}{MARK}Ａ"

    def chunks(self, text: str) -> list[str]:
        """The marked text in pieces that start with a run of markers."""
        if not text:
            return []
        marked = MARK + text.replace(" ", MARK)
        if marked[-1] != MARK and MARK * 2 not in marked:
            return marked[1:].split(MARK)          # words without their marker
        return [c[1:] for c in self.runs.findall(marked)]

    def segment(self, chunks: list[str]) -> list[tuple]:
        """Ids of chunks given without their first marker, which the library adds."""
        lone = (self.sp.piece_to_id(MARK),)
        return [tuple(x) if c else lone for c, x in zip(chunks, self.sp.encode(chunks, num_threads=1))]

    def encode(self, texts: list[str | None]) -> list[list[int]]:
        if not self.separable:
            return self.sp.encode([t or "" for t in texts], num_threads=1)
        cut = [self.chunks(t or "") for t in texts]
        if len(self.ids) > self.entries:
            self.ids = {}
        new = list(set(chain.from_iterable(cut)).difference(self.ids))
        found = dict(zip(new, self.segment(new)))
        look = self.ids
        long = {c: found.pop(c) for c in new if len(c) > LONG_CHUNK}
        look.update(found)
        if long:
            look = {**self.ids, **long}
        return [list(chain.from_iterable(map(look.__getitem__, c))) for c in cut]


def encode(docs: DataFrame, model: str, text: str = "text", ids: str = "ids", decoded: str | None = None) -> DataFrame:
    """``docs`` with an int array ``ids``: the library's ids of each whole text.
    ``decoded``: a column for the text that the ids decode to, made on the way."""

    def made(texts: list, table: ChunkTable) -> dict:
        found = table.encode(texts)
        return {ids: found} if decoded is None else {ids: found, decoded: table.sp.decode(found, num_threads=1)}

    schema = f"`{ids}` array<int>" + (f", `{decoded}` string" if decoded else "")
    return add_columns(docs, text, made, schema, make=lambda: quiet_gc(ChunkTable(model)))


def decode(encoded: DataFrame, model: str, ids: str = "ids", decoded: str = "decoded") -> DataFrame:
    """``encoded`` with the text that the library's decode gives; null ids decode to ""."""

    def make():
        import sentencepiece
        return sentencepiece.SentencePieceProcessor(model_file=model)

    return add_columns(encoded, ids, lambda v, sp: {decoded: sp.decode([x or [] for x in v], num_threads=1)},
                       f"`{decoded}` string", make=make)


def op4_sentencepiece(spark, sf_dir: str) -> DataFrame:
    import public_tokenizers

    model = public_tokenizers.path("piece_bpe_32k.model")
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    both = encode(docs, model, decoded="decoded")
    return both.select(
        "doc_id", F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), ","), 256).alias("ids_sha256"),
        F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"))
