"""SentencePiece encoding and decoding as a relational lattice.

The piece table (piece, id, score) comes from a given model file; nothing is trained. Texts are
cut into words at places that no piece spans. Each distinct word is encoded once: its substrings
up to the longest piece's length are exploded and equi-joined to the piece table, the edges found
are grouped by word, and Spark's higher-order ``aggregate`` folds Viterbi over them, which gives
the segmentation of greatest total score (ties to the longer last piece). Code points without a
piece fall back to byte pieces. Words are also cut where no piece holds the two characters on either
side. They may have any length: the fold of a long one keeps only the scores that the longest piece
can reach back to, segment by segment.

Texts are read once and written as blocks: rows of some megabytes of text, as numbers of the
block's distinct chunks (what lies between spaces), the chunks as numbers of broadcast words or of
the block's own ones, and the list of the latter. These distinct words are encoded, meet the blocks' lists
by an equi-join on the word and go back to their block by a second join, for which the blocks lie
bucketed by their number and are not moved. Which words are broadcast (at most ``MAX_HOT``, chosen
on the first texts of each partition) decides only how much work the joins have, never a result.
No task ever needs the whole vocabulary, which grows with the corpus.

Spaces are kept as such inside (the model's mark U+2581 stands for a space in pieces), so a
literal U+2581 survives as bytes and every text comes back exactly from its ids.
"""

from __future__ import annotations

import hashlib
import json
import re
import uuid
from collections import Counter
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .bytehash import released
from .common import Scratch, partitions

MODEL = "/opt/tokenizers/piece_bpe_32k.model"
#: Most frequent words that are broadcast, at most; a few dozen bytes each.
MAX_HOT = 200_000
#: They are chosen on so many bytes of each partition; any choice gives the same result.
SAMPLE_BYTES, SAMPLE_ROWS = 3 << 20, 1000
#: Bytes of text in one block; a longer text is a block of its own.
BLOCK_BYTES = 8 << 20
#: Chunks whose ids are laid out and spelled at once.
PART_CHUNKS = 1 << 17
#: Words beyond so many code points are not broadcast.
LONG = 32
#: Words beyond so many code points are folded in segments of as many.
SEGMENT = 128
UNKNOWN_PENALTY = 10.0
MARK = "▁"
#: ASCII punctuation, from which words are cut where the model's pieces allow it.
PUNCTUATION = "".join(c for c in map(chr, range(33, 127)) if not c.isalnum())
_MARKS = frozenset(PUNCTUATION)

_SPACED = re.compile(r"\n| *[^ \n]+| +")
_RUNS = re.compile(" +[^ ]*")


@dataclass(frozen=True)
class Pieces:
    """A model's pieces with spaces for marks, their scores, and the ids of its byte pieces."""

    table: tuple[tuple[str, int, float], ...]
    first_byte: int
    surface: tuple[bytes, ...]
    unknown: float
    longest: int

    @classmethod
    def load(cls, path: str = MODEL) -> Pieces:
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        table, surface, first = [], [], None
        for i in range(model.get_piece_size()):
            piece = model.id_to_piece(i).replace(MARK, " ")
            if model.is_byte(i):
                value = int(piece[3:5], 16)
                first = i if value == 0 else first
                surface.append(bytes([value]))
            elif model.is_control(i) or model.is_unknown(i) or model.is_unused(i):
                surface.append(b"")
            else:
                table.append((piece, i, float(model.get_score(i))))
                surface.append(piece.encode())
        if first is None:
            raise ValueError("the model has no byte pieces")
        if any(re.search(r"[^ ] |\n", p) for p, _, _ in table):
            raise ValueError("a piece spans a word's end")
        return cls(tuple(table), first, tuple(surface), min(s for _, _, s in table) - UNKNOWN_PENALTY, max(len(p) for p, _, _ in table))

    def spell(self, ids: np.ndarray) -> tuple[bytes, np.ndarray]:
        """The bytes of all ids, and where each id's bytes end: all pieces are laid out at once."""
        if "flat" not in self.__dict__:
            width = np.array([len(x) for x in self.surface])
            self.__dict__.update(flat=np.frombuffer(b"".join(self.surface), np.uint8), width=width, begin=np.cumsum(width) - width)
        width = self.width[ids]
        ends = np.cumsum(width)
        place = np.arange(int(ends[-1]) if len(ends) else 0) + np.repeat(self.begin[ids] - (ends - width), width)
        return self.flat[place].tobytes(), ends

    def decode(self, ids) -> str:
        raw = b"".join([self.surface[i] for i in ids])
        return raw[1:].decode("utf-8", "replace") if raw[:1] == b" " else raw.decode("utf-8", "replace")


class Cutter:
    """Cuts a text, which begins with an added space, into words whose ends no piece crosses.

    Words end before spaces and at line feeds. Runs of punctuation are words of their own, except in
    chunks with a character that some piece joins to punctuation; those stay whole. ``cut`` then cuts
    words between two characters that no piece has side by side.
    """

    def __init__(self, pieces: Pieces):
        pairs = {p[k : k + 2] for p, _, _ in pieces.table for k in range(len(p) - 1)}
        joined = {a if b in PUNCTUATION else b for a, b in pairs if (a in PUNCTUATION) != (b in PUNCTUATION) and " " not in (a, b)}
        group = lambda chars: "".join(re.escape(c) for c in sorted(chars))
        self.joined = re.compile(f"[{group(joined)}]") if joined else None
        self.letters_apart = not any(c.isalpha() for c in joined)  # no piece joins a letter to punctuation
        self.parts = re.compile(f" *[^ {group(PUNCTUATION)}]+| *[{group(PUNCTUATION)}]+")
        number = {c: k for k, c in enumerate(sorted({c for pair in pairs for c in pair}), 1)}
        self.number = np.zeros(0x110000, np.uint16)
        self.number[list(map(ord, number))] = list(number.values())
        self.together = np.zeros((len(number) + 1, len(number) + 1), bool)
        for a, b in pairs:
            self.together[number[a], number[b]] = True

    def words(self, text: str) -> list[str]:
        out = []
        for chunk in _SPACED.findall(text):
            if chunk == "\n" or chunk[-1] == " " or (self.joined is not None and self.joined.search(chunk)):
                out.append(chunk)
            else:
                out += self.parts.findall(chunk)
        return out

    def chunk(self, chunk: str) -> list[str]:
        """The words of a chunk, after the space before it."""
        if chunk.isalpha():
            return [" " + chunk]
        if self.letters_apart and chunk[-1:] in _MARKS and chunk[:-1].isalpha():
            return [" " + chunk[:-1], chunk[-1]]
        if "\n" in chunk or " " in chunk or not chunk:
            return self.words(" " + chunk)
        return [" " + chunk] if self.joined is not None and self.joined.search(chunk) else self.parts.findall(" " + chunk)

    def cut(self, words: pa.Array) -> tuple[list[str], np.ndarray]:
        """The parts of all words in a row, and how many each has."""
        text = "".join(words.to_pylist())
        if not text:
            return [], np.zeros(len(words), np.int64)
        number = self.number[np.frombuffer(text.encode("utf-32-le"), np.uint32)]
        apart = np.ones(len(number) + 1, bool)
        apart[1:-1] = ~self.together[number[:-1], number[1:]]
        ends = np.cumsum(pc.utf8_length(words).to_numpy())
        apart[ends] = True
        cuts = np.flatnonzero(apart)
        bounds = cuts.tolist()
        return [text[a:b] for a, b in zip(bounds, bounds[1:])], np.diff(np.searchsorted(cuts, ends), prepend=0)


# an edge as one long, so that edges sort as numbers: its end, its start, and its piece's id plus 1 (0: no piece)
def _code(e: Column, i: Column, id: Column) -> Column:
    return F.shiftleft(e.cast("long"), 40) + F.shiftleft(i.cast("long"), 28) + F.coalesce(id + 1, F.lit(0))


def _end(code: Column) -> Column:
    return F.shiftright(code, 40).cast("int")


def _start(code: Column) -> Column:
    return F.shiftright(code, 28).bitwiseAND(F.lit(4095)).cast("int")


def _piece(code: Column) -> Column:
    return code.bitwiseAND(F.lit((1 << 28) - 1)).cast("int")


def best_path(edges: Column, scores: Column) -> Column:
    """Viterbi over sorted edge codes; ``scores`` by id plus 1.

    For each end the fold keeps the best score and its path: ids, or -1 - start for a code point
    without a piece.
    """
    start = F.array(F.struct(F.lit(0.0).alias("score"), F.array().cast("array<int>").alias("path")))

    def step(best: Column, edge: Column) -> Column:
        source, e = F.get(best, _start(edge)), _end(edge)
        total = source["score"] + F.get(scores, _piece(edge))
        taken = F.array(F.struct(total.alias("score"), F.concat(source["path"], F.array(F.when(_piece(edge) > 0, _piece(edge) - 1).otherwise(-1 - _start(edge)))).alias("path")))
        return F.when(F.size(best) <= e, F.concat(best, taken)).when(total > F.get(best, e)["score"], F.concat(F.slice(best, F.lit(1), e), taken)).otherwise(best)

    return F.aggregate(edges, start, step, lambda best: F.element_at(best, -1)["path"])


def _bytes_of(character: Column, first_byte: int) -> Column:
    code = F.hex(F.encode(character, "utf-8"))
    return F.transform(F.sequence(F.lit(0), (F.length(code) / 2).cast("int") - 1), lambda k: F.conv(F.substring(code, 2 * k + 1, F.lit(2)), 16, 10).cast("int") + first_byte)


def _substrings(words: DataFrame, longest: int, most: Column) -> DataFrame:
    """Rows of ``words`` with ``at``, ``k`` and ``part``: the substrings of ``form`` that start at 1 to ``most``."""
    spread = words.withColumn("at", F.explode(F.sequence(F.lit(1), most)))
    spread = spread.withColumn("k", F.explode(F.sequence(F.lit(1), F.least(F.lit(longest), F.length("form") - F.col("at") + 1))))
    return spread.withColumn("part", F.substring(F.col("form"), F.col("at"), F.col("k")))


def _edges(substrings: DataFrame, pieces: Pieces) -> DataFrame:
    """The equi-join with the piece table, which has as many rows as the model; code points without a piece stay with a null ``id``."""
    table = substrings.sparkSession.createDataFrame(list(pieces.table), "piece string, id int, score double")
    # the join's key is the substring's 64-bit hash, which Spark looks up faster than strings; then strings are compared
    table = table.withColumn("key", F.xxhash64("piece"))
    met = substrings.join(F.broadcast(table), F.xxhash64("part") == F.col("key"), "left")
    return met.withColumn("id", F.when(F.col("part") == F.col("piece"), F.col("id"))).where("id is not null or k = 1")


def encode_words(words: DataFrame, pieces: Pieces) -> DataFrame:
    """``word, ids`` for distinct words ``(word, ...)`` of at most ``SEGMENT`` code points."""
    by_id = {i + 1: s for _, i, s in pieces.table} | {0: pieces.unknown}
    scores = F.from_json(F.lit(json.dumps([by_id.get(k, pieces.unknown) for k in range(max(by_id) + 1)])), "array<double>")
    edges = _edges(_substrings(words.select(F.col("word").alias("form")), pieces.longest, F.length("form")), pieces)
    code = _code(F.col("at") + F.col("k") - 1, F.col("at") - 1, F.col("id"))
    grouped = edges.groupBy("form").agg(F.sort_array(F.collect_list(code)).alias("edges"))
    path = grouped.select(F.col("form").alias("word"), best_path(F.col("edges"), scores).alias("path"))
    spelled = lambda x: _bytes_of(F.substring(F.col("word"), -x, F.lit(1)), pieces.first_byte)
    bytes_too = F.flatten(F.transform("path", lambda x: F.when(x >= 0, F.array(x)).otherwise(spelled(x))))
    return path.select("word", F.when(F.array_min("path") < 0, bytes_too).otherwise(F.col("path")).alias("ids"))


def encode_long_words(words: DataFrame, pieces: Pieces) -> DataFrame:
    """``word, ids`` for distinct words of any length.

    Words are cut into segments that overlap by the longest piece, so that no row of the lattice
    carries a long word. The candidates of each end are grouped, ends by segment, segments by word.
    The fold keeps the scores of the last ends that a piece can reach back to, and for each end the
    start and ids of its best piece; these are then followed from the word's end to its start.
    """
    L = pieces.longest
    key = (F.xxhash64("word").alias("k1"), F.xxhash64(F.lit(1), "word").alias("k2"))
    cut = words.select(*key, F.posexplode(F.transform(F.sequence(F.lit(0), F.floor((F.length("word") - 1) / SEGMENT).cast("int")), lambda s: F.substring(F.col("word"), s * SEGMENT + 1, F.lit(SEGMENT + L - 1)))).alias("segment", "form"))
    edges = _edges(_substrings(cut, L, F.least(F.lit(SEGMENT), F.length("form"))), pieces)
    start = F.col("segment") * SEGMENT + F.col("at") - 1
    ids = F.when(F.col("id").isNotNull(), F.array("id")).otherwise(_bytes_of(F.col("part"), pieces.first_byte))
    candidate = F.struct(start.alias("start"), F.when(F.col("id").isNotNull(), F.col("score")).otherwise(F.lit(pieces.unknown)).alias("score"), ids.alias("ids"))
    ends = edges.select("k1", "k2", (start + F.col("k")).alias("e"), candidate.alias("c")).groupBy("k1", "k2", "e").agg(F.collect_list("c").alias("cands"))
    segments = ends.groupBy("k1", "k2", F.floor((F.col("e") - 1) / SEGMENT).alias("segment")).agg(F.sort_array(F.collect_list(F.struct("e", "cands"))).alias("ends"))
    folded = segments.groupBy("k1", "k2").agg(F.sort_array(F.collect_list(F.struct("segment", "ends"))).alias("segments"))
    path = folded.select("k1", "k2", _fold(F.transform("segments", lambda s: s["ends"]), L).alias("ids"))
    return words.select("word", *key).join(path, ["k1", "k2"]).select("word", "ids")


def _fold(segments: Column, longest: int) -> Column:
    chosen = "array<struct<e:int,start:int,ids:array<int>>>"

    def end(acc: Column, x: Column) -> Column:
        best = F.array_max(F.transform(x["cands"], lambda c: F.struct((F.element_at(acc["scores"], c["start"] - x["e"]) + c["score"]).alias("total"), (-c["start"]).alias("back"), c["ids"].alias("ids"))))
        held = F.when(F.size(acc["scores"]) < longest, acc["scores"]).otherwise(F.slice(acc["scores"], 2, longest))
        take = lambda b: F.struct(F.concat(held, F.array(b["total"])).alias("scores"), F.concat(acc["chosen"], F.array(F.struct(x["e"].alias("e"), (-b["back"]).alias("start"), b["ids"].alias("ids")))).alias("chosen"))
        return F.get(F.transform(F.array(best), take), F.lit(0))

    def segment(acc: Column, ends: Column) -> Column:
        inner = F.aggregate(ends, F.struct(acc["scores"].alias("scores"), F.array().cast(chosen).alias("chosen")), end)
        return F.get(F.transform(F.array(inner), lambda x: F.struct(x["scores"].alias("scores"), F.concat(acc["done"], F.array(x["chosen"])).alias("done"))), F.lit(0))

    ahead = F.aggregate(segments, F.struct(F.array(F.lit(0.0)).alias("scores"), F.array().cast(f"array<{chosen}>").alias("done")), segment, lambda acc: acc["done"])

    def back(acc: Column, x: Column) -> Column:
        return F.when((acc["at"] == x["e"]) | (acc["at"] < 0), F.struct(x["start"].alias("at"), F.concat(F.array(x["ids"]), acc["path"]).alias("path"))).otherwise(acc)

    def segment_back(acc: Column, ends: Column) -> Column:
        inner = F.aggregate(F.reverse(ends), F.struct(acc["at"].alias("at"), F.array().cast("array<array<int>>").alias("path")), back)
        return F.get(F.transform(F.array(inner), lambda x: F.struct(x["at"].alias("at"), F.concat(F.array(F.flatten(x["path"])), acc["path"]).alias("path"))), F.lit(0))

    # the last end of all is taken as it is (at < 0 stands for "any end")
    return F.aggregate(F.reverse(ahead), F.struct(F.lit(-1).alias("at"), F.array().cast("array<array<int>>").alias("path")), segment_back, lambda acc: F.flatten(acc["path"]))


def encode_distinct(words: DataFrame, pieces: Pieces) -> DataFrame:
    """``word, ids`` for distinct words of any length; partitioned by word, the short ones need no further shuffle."""
    short = encode_words(words.where(F.length("word") <= SEGMENT), pieces)
    return short.unionByName(encode_long_words(words.where(F.length("word") > SEGMENT), pieces))


def _chunks(texts: pa.Array) -> tuple[pa.Array, pa.Array]:
    """Lists of each text's chunks, and which texts have an empty one inside or in front.

    A chunk is what lies between two spaces; of several spaces all but the first belong to the chunk
    behind them. An empty text has no chunk.
    """
    odd = pc.or_(pc.match_substring(texts, "  "), pc.starts_with(texts, " "))
    plain = pc.if_else(pc.or_(odd, pc.equal(texts, "")), pa.scalar(None, pa.large_string()), texts)
    return pc.split_pattern(plain, " "), odd


def _count_first(shared) -> Callable:
    """Words of each partition's first texts that occur there more than once, and how often they do."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cutter, chunks, room = Cutter(shared.value), Counter(), SAMPLE_BYTES
        for batch in batches:
            texts = batch.column("text").cast(pa.large_string())
            size = np.cumsum(pc.binary_length(texts).to_numpy(zero_copy_only=False))
            texts = texts.slice(0, int(np.searchsorted(size, room)) + 1)
            found = pc.value_counts(_chunks(texts)[0].flatten())
            for chunk, n in zip(found.field(0).to_pylist(), found.field(1).to_pylist(), strict=True):
                chunks[chunk] += n
            room -= int(size[-1]) if len(size) else 0
            if room < 0:
                break
        wholes: Counter[str] = Counter()
        for chunk, n in chunks.items():
            for word in cutter.chunk(chunk):
                wholes[word] += n
        words: Counter[str] = Counter()
        parts, each = cutter.cut(pa.array(list(wholes), pa.large_string()))
        for word, n in zip(parts, np.repeat(np.fromiter(wholes.values(), np.int64, len(wholes)), each).tolist(), strict=True):
            words[word] += n
        often = [(w, n) for w, n in words.items() if n > 1 and len(w) <= LONG]
        yield pa.RecordBatch.from_arrays([pa.array([w for w, _ in often], pa.string()), pa.array([n for _, n in often], pa.int64())], names=["word", "n"])

    return run


def hot_limit(counted: DataFrame, most: int) -> int:
    """The least count such that at most ``most`` words occur as often; from a histogram of at most 1,000 bars."""
    bars = counted.groupBy(F.least("n", F.lit(1000)).alias("n")).agg(F.count("*").alias("words")).collect()
    total = 0
    for bar in sorted(bars, key=lambda b: -b["n"]):
        total += bar["words"]
        if total > most:
            return bar["n"] + 1
    return 1


class _Hot:
    """The broadcast words, in order, and their ids. Travels as Arrow bytes and opens once in each worker."""

    def __init__(self, table: pa.Table):
        sink = pa.BufferOutputStream()
        with pa.ipc.new_stream(sink, table.schema) as out:
            out.write_table(table)
        self.raw = sink.getvalue().to_pybytes()

    def table(self) -> pa.Table:
        return pa.ipc.open_stream(self.raw).read_all().combine_chunks()

    def words(self) -> pa.Array:
        return pa.concat_arrays([pa.array([], pa.large_string()), *self.table().column("word").cast(pa.large_string()).chunks])

    def ids(self) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all words, and where each word's end."""
        lists = pa.concat_arrays([pa.array([], pa.list_(pa.int32())), *self.table().column("ids").cast(pa.list_(pa.int32())).chunks])
        return lists.flatten().to_numpy(), np.cumsum(pc.list_value_length(lists).to_numpy())


def _planes(values: np.ndarray) -> bytes:
    """32-bit numbers, the bytes of each rank together, compressed."""
    raw = values.astype("<u4").view(np.uint8).reshape(-1, 4).T.tobytes()
    return len(raw).to_bytes(8, "little") + pa.compress(raw, "zstd", asbytes=True)


def _numbers(packed: bytes) -> np.ndarray:
    size = int.from_bytes(packed[:8], "little")
    raw = pa.decompress(packed[8:], size, "zstd", asbytes=True)
    return np.ascontiguousarray(np.frombuffer(raw, np.uint8).reshape(4, -1).T).view("<u4").ravel().astype(np.int64)


def _looked_up(words: pa.Array, known: pa.Array) -> tuple[np.ndarray, pa.Array]:
    """A number for each word: its place among the known ones, or behind them its place among the others, which come too."""
    found = pc.index_in(words, value_set=known)
    other = found.is_null().to_numpy(zero_copy_only=False)
    rest = words.filter(pa.array(other)).dictionary_encode()
    out = pc.fill_null(found, 0).to_numpy().astype(np.int64)
    out[other] = len(known) + rest.indices.to_numpy()
    return out, rest.dictionary


class _Block:
    """Texts as numbers of chunks, and chunks as numbers of words: the broadcast ones, then the block's own."""

    def __init__(self, hot: _Hot, cutter: Cutter):
        self.known, self.cutter = hot.words(), cutter

    def forms(self, chunks: pa.Array) -> tuple[np.ndarray, np.ndarray, pa.Array]:
        """Word numbers of distinct chunks in a row, how many each has, and the own words."""
        letters = pc.utf8_is_alpha(chunks).to_numpy(zero_copy_only=False)
        stems = pc.utf8_slice_codeunits(chunks, 0, -1)
        marked = pc.and_(pc.is_in(pc.utf8_slice_codeunits(chunks, -1, None), value_set=pa.array(list(PUNCTUATION), pa.large_string())), pc.utf8_is_alpha(stems)).to_numpy(zero_copy_only=False) & self.cutter.letters_apart
        plain = letters | marked
        words = pc.binary_join_element_wise(pa.scalar("", pa.large_string()), pc.if_else(pa.array(letters), chunks, stems).filter(pa.array(plain)), pa.scalar(" ", pa.large_string()))
        rest = [self.cutter.chunk(c) for c in chunks.filter(pa.array(~plain)).to_pylist()]
        sizes = np.where(marked, 2, 1)
        sizes[~plain] = [len(r) for r in rest]
        # one-word chunks, then the marks behind them, then the words of the rest: all looked up together
        marks = pc.utf8_slice_codeunits(chunks, -1, None).filter(pa.array(marked))
        numbers, own = _looked_up(pa.concat_arrays([words, marks, pa.array([w for r in rest for w in r], pa.large_string())]), self.known)
        begin = np.cumsum(sizes) - sizes
        out = np.empty(int(sizes.sum()), np.int64)
        out[begin[plain]] = numbers[: len(words)]
        out[begin[marked] + 1] = numbers[len(words) : len(words) + len(marks)]
        out[np.repeat(~plain, sizes)] = numbers[len(words) + len(marks) :]
        return out, sizes, own

    def cut(self, forms: np.ndarray, sizes: np.ndarray, own: pa.Array) -> tuple[np.ndarray, np.ndarray, pa.Array]:
        """The same with the block's own words cut; their parts are broadcast words or own ones."""
        parts, each = self.cutter.cut(own)
        numbers, kept = _looked_up(pa.array(parts, pa.large_string()), self.known)
        begin, n = np.cumsum(each) - each, len(self.known)
        mine = forms >= n
        at = np.where(mine, forms - n, 0)
        width = np.where(mine, each[at] if len(each) else 0, 1)
        first = np.where(mine, begin[at] if len(each) else 0, len(numbers) + np.arange(len(forms)))
        out, ends = _gathered(np.concatenate([numbers, forms]), first, width)
        stops = np.append(0, ends)[np.append(0, np.cumsum(sizes))]
        return out, np.diff(stops), kept

    def row(self, number: int, docs: pa.Array, texts: pa.Array) -> pa.RecordBatch:
        """The texts with several spaces in a row come last."""
        chunks, odd = _chunks(texts)
        n_odd = pc.sum(odd).as_py() or 0
        if n_odd:
            order = pa.array(np.argsort(odd.to_numpy(zero_copy_only=False), kind="stable"))
            docs, texts, chunks = docs.take(order), texts.take(order), chunks.take(order)
        counts = pc.fill_null(pc.list_value_length(chunks), 0).to_numpy().astype(np.int32)
        rest = [[run[1:] for run in _RUNS.findall(" " + t)] for t in texts.slice(len(texts) - n_odd).to_pylist()]
        counts[len(counts) - n_odd :] = [len(r) for r in rest]
        flat = pa.concat_arrays([chunks.flatten(), pa.array([c for r in rest for c in r], pa.large_string())]).dictionary_encode()
        forms, sizes, own = self.cut(*self.forms(flat.dictionary))
        ends, raw = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + len(texts) + 1].tolist(), memoryview(texts.buffers()[2] or b"")
        digests = b"".join([hashlib.blake2b(raw[a:b], digest_size=16).digest() for a, b in zip(ends, ends[1:])])
        longest = pc.max(pc.utf8_length(own)).as_py() or 0
        values = [[number], [docs], [counts], [digests], [_planes(flat.indices.to_numpy())], [_planes(sizes)], [_planes(forms)], [own.cast(pa.string())], [longest]]
        kinds = [pa.int64(), pa.list_(pa.int64()), pa.list_(pa.int32()), *[pa.binary()] * 4, pa.list_(pa.string()), pa.int32()]
        return pa.RecordBatch.from_arrays([pa.array(v, k) for v, k in zip(values, kinds, strict=True)], names=[f.split()[0] for f in _BLOCKS.split(", ")])


_BLOCKS = "block long, docs array<long>, counts array<int>, digests binary, texts binary, sizes binary, forms binary, words array<string>, longest int"


def _blocks(hot, shared, size: int) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block = _Block(hot.value, Cutter(shared.value))
        number = TaskContext.get().partitionId() << 32
        docs, texts, room = [], [], size
        for batch in (part.slice(at, 1000) for part in batches for at in range(0, part.num_rows, 1000)):
            ids, column = batch.column("doc_id"), pc.fill_null(batch.column("text").cast(pa.large_string()), "")
            ends = np.cumsum(pc.binary_length(column).to_numpy())
            a = 0
            while a < len(ids):
                begin = int(ends[a - 1]) if a else 0
                b = int(np.searchsorted(ends, begin + room, side="right"))
                if b == a and not texts:
                    b = a + 1  # a text beyond the size
                docs.append(ids.slice(a, b - a))
                texts.append(column.slice(a, b - a))
                if b < len(ids):  # full
                    yield block.row(number, pa.concat_arrays(docs), pa.concat_arrays(texts))
                    number, docs, texts, room = number + 1, [], [], size
                else:
                    room -= int(ends[b - 1]) - begin if b > a else 0
                a = b
        if sum(map(len, docs)):
            yield block.row(number, pa.concat_arrays(docs), pa.concat_arrays(texts))

    return run


def _gathered(flat: np.ndarray, begin: np.ndarray, width: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The ranges of ``flat`` one after the other, and where each ends."""
    ends = np.cumsum(width)
    place = np.arange(int(ends[-1]) if len(ends) else 0) + np.repeat(begin - (ends - width), width)
    return flat[place], ends


_ENCODED = "doc_id long, ids array<int>, n_tokens long, round_trip boolean"


def _assemble(hot, shared, kind: np.dtype) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces = shared.value
        flat, stops = hot.value.ids()
        for batch in batches:
            for i in range(batch.num_rows):
                row = batch.slice(i, 1)
                forms, sizes, texts = (_numbers(row.column(c)[0].as_py()) for c in ("forms", "sizes", "texts"))
                counts = row.column("counts").flatten().to_numpy()
                own = row.column("own").flatten()
                at = np.frombuffer(own.buffers()[1], np.int32)[own.offset : own.offset + len(own) + 1] if len(own) else np.zeros(1, np.int32)
                raw = np.frombuffer(own.buffers()[2], np.uint8) if len(own) else np.empty(0, np.uint8)
                # an entry: four bytes of the word's number, then its ids
                slot = raw[at[:-1, None] + np.arange(4)[None]].astype(np.int64) @ [1 << 24, 1 << 16, 1 << 8, 1]
                lone, width = at[:-1] + 4, (np.diff(at) - 4) // kind.itemsize
                place = _gathered(np.arange(len(raw)), lone, width * kind.itemsize)[0]
                ids, ends = raw[place].view(kind).astype(np.int32), np.append(0, np.cumsum(width))
                # every word: the broadcast ones, then the block's own by their number
                begin, width = np.zeros(len(stops) + len(slot), np.int64), np.zeros(len(stops) + len(slot), np.int64)
                begin[: len(stops)], width[: len(stops)] = np.append(0, stops[:-1])[: len(stops)], np.diff(stops, prepend=0)
                begin[len(stops) + slot], width[len(stops) + slot] = len(flat) + ends[:-1], np.diff(ends)
                ids, last = _gathered(np.concatenate([flat, ids]), begin[forms], width[forms])
                bounds = np.append(0, last)[np.append(0, np.cumsum(sizes))]
                begin, width = bounds[:-1], np.diff(bounds)
                digests = row.column("digests")[0].as_py()
                docs, bounds = row.column("docs").flatten(), np.concatenate([[0], np.cumsum(counts)])
                a = 0
                while a < len(docs):
                    b = max(a + 1, int(np.searchsorted(bounds, bounds[a] + PART_CHUNKS, side="right")) - 1)
                    part = texts[bounds[a] : bounds[b]]
                    out, last = _gathered(ids, begin[part], width[part])
                    cuts = np.concatenate([[0], last])[bounds[a : b + 1] - bounds[a]]
                    raw, spelled = pieces.spell(out)
                    sides = np.concatenate([[0], spelled])[cuts]
                    right = []
                    for k, (x, y) in enumerate(zip(sides[:-1].tolist(), sides[1:].tolist(), strict=True), a):
                        right.append((x == y or raw[x : x + 1] == b" ") and hashlib.blake2b(raw[x + 1 : y], digest_size=16).digest() == digests[16 * k : 16 * k + 16])
                    lists = pa.ListArray.from_arrays(pa.array(cuts.astype(np.int32)), pa.array(out.astype(np.int32)))
                    yield pa.RecordBatch.from_arrays([docs.slice(a, b - a), lists, pa.array(np.diff(cuts).astype(np.int64)), pa.array(right, pa.bool_())], names=[f.split()[0] for f in _ENCODED.split(", ")])
                    a = b

    return run


def _packed(ids: Column, kind: np.dtype) -> Column:
    """Ids as bytes of ``kind``, the highest first."""
    return F.unhex(F.array_join(F.transform(ids, lambda x: F.lpad(F.hex(x), 2 * kind.itemsize, "0")), ""))


def _bucketed(scratch: Scratch, df: DataFrame, name: str, column: str) -> DataFrame:
    """A table in the scratch folder with a file for each bucket of ``column`` a task has: a join on it moves only the other side."""
    spark, table = df.sparkSession, f"lakeloom_{name}_{uuid.uuid4().hex}"
    df.write.format("parquet").option("compression", "zstd").mode("overwrite").bucketBy(partitions(spark), column).option("path", f"{scratch.root}/{name}").saveAsTable(table)
    found = spark.table(table)
    found.schema  # resolved before the name goes; the files stay
    spark.sql(f"drop table {table}")
    return found


def encode(docs: DataFrame, pieces: Pieces | None = None, max_hot: int = MAX_HOT, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """``doc_id, ids, n_tokens, round_trip`` for every row of ``docs(doc_id, text, ...)``.

    ``round_trip`` says that the ids decode to the very text (by a 128-bit digest of it). A null or
    empty text has no ids and is its own round trip; repeated rows and null ids are encoded each;
    words of any length are encoded whole; further columns are ignored; no rows give no rows.
    """
    spark = docs.sparkSession
    scratch = Scratch(spark, "pieces")
    pieces = pieces or Pieces.load()
    shared = spark.sparkContext.broadcast(pieces)
    narrow = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    # the first rows of a partition, by their place in it
    first = narrow.select("text").where((F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1)) < SAMPLE_ROWS) & (F.col("text") != "")).mapInArrow(lambda b: released(_count_first(shared)(b)), "word string, n long")
    first = scratch.save(first.groupBy("word").agg(F.sum("n").alias("n")), "first")
    common = first.where(F.col("n") >= hot_limit(first, max_hot))  # at most max_hot words
    hot = spark.sparkContext.broadcast(_Hot(encode_words(common.repartition(partitions(spark), "word"), pieces).toArrow()))
    scratch.drop("first")
    blocks = _bucketed(scratch, narrow.mapInArrow(lambda b: released(_blocks(hot, shared, block_bytes)(b)), _BLOCKS), "blocks", "block")
    # many small partitions: a word becomes some seventy rows; distinct words and the join stand on this one exchange, as both need all its columns
    listed = spark.read.schema(blocks.schema).parquet(f"{scratch.root}/blocks")
    words = listed.select("block", F.posexplode("words").alias("slot", "word")).where("block is not null and slot is not null and word is not null").repartition(8 * partitions(spark), "word")
    distinct = words.groupBy("word").agg(F.min("block").alias("b"), F.min("slot").alias("s")).where("b >= 0 and s >= 0").select("word")
    kind = np.dtype(">u2" if len(pieces.surface) <= 1 << 16 else ">u4")
    longest = listed.agg(F.max("longest")).first()[0] or 0
    encoded = (encode_words(distinct, pieces) if longest <= SEGMENT else encode_distinct(distinct, pieces)).select(F.col("word").alias("form"), _packed(F.col("ids"), kind).alias("ids"))
    entry = F.concat(F.unhex(F.lpad(F.hex("slot"), 8, "0")), "ids").alias("entry")
    own = words.join(encoded.hint("shuffle_hash"), F.col("word") == F.col("form")).select(F.col("block").alias("of"), entry).groupBy("of").agg(F.collect_list("entry").alias("own"))
    filled = blocks.join(own, F.col("block") == F.col("of"), "left").select("docs", "counts", "digests", "texts", "sizes", "forms", F.coalesce("own", F.array().cast("array<binary>")).alias("own"))
    return filled.mapInArrow(lambda b: released(_assemble(hot, shared, kind)(b)), _ENCODED)


def decode(encoded: DataFrame, pieces: Pieces | None = None) -> DataFrame:
    """``doc_id, text`` of rows ``(doc_id, ids, ...)``; null ids give a null text, ids not of the model fail."""
    shared = encoded.sparkSession.sparkContext.broadcast(pieces or Pieces.load())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [None if ids is None else shared.value.decode(ids) for ids in batch.column("ids").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(texts, pa.string())], names=["doc_id", "text"])

    return encoded.select("doc_id", "ids").mapInArrow(run, "doc_id long, text string")
