"""Sequence packing: first-fit decreasing on a tournament tree, in randomised groups of documents."""

from __future__ import annotations

import functools
import gc
import json
import os
import re
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sluice.llm.common import release, text_batches

#: Distinct words, and pieces, whose ids a worker process keeps; once full, words of the texts at hand stay.
WORDS_KEPT = 450_000
#: Characters of a text that are split into words at once.
BLOCK = 1 << 20
#: What a tokenizer of words takes for white space; str.split() would also split at U+001C to U+001F.
_SPACE = re.compile(r"(?:(?![\x1c-\x1f])\s)+")
_UNLIKE = ("\x1c", "\x1d", "\x1e", "\x1f")
#: Words of ASCII and Latin-1 letters, which are composed already and lower-cased one by one ...
_PLAIN = re.compile(r"[\x21-\x7eÀ-ÖØ-öø-ÿ]+").fullmatch
#: The tokenizer's own pattern, and how it cuts such words once they are lower-cased.
CUT = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
_PIECE = re.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[a-zß-öø-ÿ]+|[0-9]|[^a-z0-9ß-öø-ÿ]+").findall


def split_words(text: str) -> list[str]:
    return _SPACE.split(text) if any(c in text for c in _UNLIKE) else text.split()


class WordEncoder:
    """Ids of texts as little-endian unsigned 32-bit bytes, by the lower-casing word BPE.

    That tokenizer never joins over white space, so a text's ids are those of its
    words in order, and each distinct word is encoded once and kept. A plain word is
    further made of pieces (runs of letters, digits, runs of signs), which many words
    share. Fresh words and pieces are encoded many at a time in one line; each id goes
    to the word in which its span begins.
    """

    def __init__(self, tokenizer_path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(tokenizer_path)
        rules = json.loads(self.tokenizer.to_str())
        cuts = [x.get("pattern", {}).get("Regex") for x in (rules["pre_tokenizer"] or {}).get("pretokenizers", [])]
        changes = [x["type"] for x in (rules["normalizer"] or {}).get("normalizers", [])]
        if CUT not in cuts or changes != ["NFC", "Replace", "Lowercase"]:
            raise ValueError(f"{tokenizer_path} is not a lower-casing word BPE that cuts words by {CUT}")
        self.words: dict[str, bytes] = {"": b""}
        self.pieces: dict[str, bytes] = {}

    def _encode_line(self, words: list[str], whole: bool) -> list[bytes]:
        """Ids of each of the words; ``whole``: none is cut by the tokenizer's pattern, so its own numbering serves."""
        done: list[bytes] = []
        for i in range(0, len(words), 4096):
            part = words[i : i + 4096]
            line = self.tokenizer.encode(" ".join(part), add_special_tokens=False)
            ids = np.array(line.ids, "<u4")
            if whole:
                cuts = np.searchsorted(np.array(line.word_ids), np.arange(len(part) + 1))
            else:
                begins = np.fromiter((a for a, _ in line.offsets), np.int64, len(ids))
                cuts = np.searchsorted(begins, np.cumsum([0] + [len(w) + 1 for w in part]))
            data, cuts = ids.tobytes(), (4 * cuts).tolist()
            done += [data[a:b] for a, b in zip(cuts, cuts[1:])]
        return done

    def learn(self, fresh: set[str]) -> None:
        alone, plain, other, cut, pieces = [], [], [], [], self.pieces
        for w in fresh:
            if w.isascii() and w.isalpha():
                alone.append(w)
            elif _PLAIN(w) and "<|" not in w:
                plain.append(w)
                cut.append(_PIECE(w.lower()))
            else:
                other.append(w)
        lower = [w.lower() for w in alone]
        new = list(set(lower).union(*cut) - pieces.keys())
        pieces.update(zip(new, self._encode_line(new, True)))
        self.words.update(zip(alone, map(pieces.__getitem__, lower)))
        self.words.update(zip(plain, [pieces[p[0]] if len(p) == 1 else b"".join([pieces[x] for x in p]) for p in cut]))
        self.words.update(zip(other, self._encode_line(other, False)))

    def _join(self, lists: list[list[str]]) -> list[bytes]:
        all_words = set().union(*lists)
        fresh = all_words - self.words.keys()
        if len(self.words) + len(fresh) > WORDS_KEPT:  # common words stand in the texts at hand too
            self.words = {"": b""} | {w: self.words[w] for w in all_words - fresh}
        if len(self.pieces) > WORDS_KEPT:
            self.pieces = {}
        self.learn(fresh)
        kept = self.words.__getitem__
        return [b"".join(map(kept, words)) for words in lists]

    def _long(self, text: str) -> bytes:
        out, at = [], 0
        while at < len(text):
            stop = len(text)
            if stop - at > BLOCK and (space := _SPACE.search(text, at + BLOCK)):
                stop = space.start()
            out += self._join([split_words(text[at:stop])])
            at = stop
        return b"".join(out)

    def encode(self, texts: list[str]) -> list[bytes]:
        short = iter(self._join([split_words(t) for t in texts if len(t) <= BLOCK]))
        return [next(short) if len(t) <= BLOCK else self._long(t) for t in texts]


@functools.cache
def encoder(tokenizer_path: str) -> WordEncoder:
    """One per worker process, so that the tasks it runs share the words."""
    return WordEncoder(tokenizer_path)


def tokenize(docs: DataFrame, tokenizer_path: str, id_col: str = "doc_id", text_col: str = "text", end_id: int = 1, piece: int = 2048, payload: str = "ids", keep_words: bool = True) -> DataFrame:
    """One row per document: (id, doc_tokens, pieces).

    ``keep_words``: whether a worker keeps the words it has encoded for its next tasks,
    which saves a tenth of the time; without, it gives their room back after each.

    A document's ids are its text's (null: none) and then ``end_id``; every
    ``piece`` of them are a piece and what is left is the last. ``pieces`` holds of
    each piece in order its ids (payload "ids": binary, little-endian unsigned 32
    bits) or only their CRC-32 (payload "crc32": long).
    """
    end, step, ids = np.array([end_id], "<u4").tobytes(), 4 * piece, payload == "ids"

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        encode = (encoder if keep_words else WordEncoder)(tokenizer_path).encode
        gc.disable()  # nothing here is cyclic, and its scans of the kept words cost a tenth of the time
        try:
            yield from encoded(batches, encode)
        finally:
            del encode
            gc.enable()
            release()

    def encoded(batches, encode):
        for pdf in batches:
            for lo in range(0, len(pdf), 1024):
                part = pdf.iloc[lo : lo + 1024]
                tokens, pieces = [], []
                for data in encode([t or "" for t in part["text"]]):
                    data += end
                    tokens.append(len(data) // 4)
                    cutouts = (data[i : i + step] for i in range(0, len(data), step))
                    pieces.append([x if ids else zlib.crc32(x) for x in cutouts])
                yield pd.DataFrame({"id": part["id"].array, "doc_tokens": tokens, "pieces": pieces})

    own = docs.select(F.col(f"`{id_col}`").cast("long").alias("id"), F.col(f"`{text_col}`").alias("text"))
    text_batches(docs.sparkSession)
    return own.mapInPandas(run, f"id long, doc_tokens long, pieces array<{'binary' if ids else 'long'}>")


class TournamentTree:
    """Free room of bins; finds the first bin that has room in O(log bins)."""

    def __init__(self, bins: int, capacity: int):
        self.leaves = 1 << max(0, bins - 1).bit_length()
        self.room = [capacity] * (2 * self.leaves)

    def place(self, length: int) -> tuple[int, int]:
        """Put a length in the first bin with room: (bin, room it had)."""
        room, i = self.room, 1
        while i < self.leaves:
            i *= 2
            if room[i] < length:
                i += 1
        had = room[i]
        room[i] = had - length
        at = i
        while at > 1:
            at >>= 1
            best = max(room[2 * at], room[2 * at + 1])
            if room[at] == best:
                break
            room[at] = best
        return i - self.leaves, had


def first_fit_decreasing(lengths: list[int], capacity: int) -> tuple[list[int], list[int]]:
    """Bin and offset of each length (each 1..capacity), longest first, ties in the order given."""
    tree, bins, offsets = TournamentTree(len(lengths), capacity), [0] * len(lengths), [0] * len(lengths)
    for i in sorted(range(len(lengths)), key=lambda i: -lengths[i]):
        bins[i], had = tree.place(lengths[i])
        offsets[i] = capacity - had
    return bins, offsets


def pack(tokens: DataFrame, documents: int, capacity: int = 2048, group_docs: int = 8192, id_col: str = "doc_id", payload: str = "ids") -> DataFrame:
    """Pack the pieces of ``tokenize`` into sequences: one row per piece. ``documents``: how many there are.

    Documents are dealt into groups of about ``group_docs`` by a hash of what they
    hold, and each group is packed by itself, so the work is linear in the corpus
    and a task holds one group's lengths. A full piece is a sequence of its own;
    the others are packed by first-fit decreasing. ``sequence_id`` has the group in
    the upper 31 bits and a number within it below. Repeated rows are further
    documents; a document without text is one piece of its end id; an empty table
    gives an empty result.
    """
    groups = max(1, -(-documents // group_docs))
    kind = dict(tokens.dtypes)["pieces"][6:-1]

    def run(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
        sums = [tuple(p) for p in pdf["pieces"]]
        pdf = pdf.assign(pieces=sums).sort_values(["doc_tokens", "id", "pieces"], kind="stable", ignore_index=True)
        doc_tokens, pieces = pdf["doc_tokens"].tolist(), pdf["pieces"].tolist()
        rest = [n - capacity * (len(p) - 1) for n, p in zip(doc_tokens, pieces)]
        bins, offsets = first_fit_decreasing(rest, capacity)
        bins_used, base, rows = max(bins, default=-1) + 1, int(key[0]) << 32, []
        for doc, n, p, left, b, o in zip(pdf["id"], doc_tokens, pieces, rest, bins, offsets):
            for i, x in enumerate(p[:-1]):
                rows.append((doc, i * capacity, capacity, x, n, base + bins_used, 0))
                bins_used += 1
            rows.append((doc, n - left, left, p[-1], n, base + b, o))
        out = pd.DataFrame(rows, columns=[id_col, "start", "length", payload, "doc_tokens", "sequence_id", "offset"])
        return out.astype({id_col: "Int64"})

    dealt = tokens.withColumn("g", F.pmod(F.xxhash64("id", "doc_tokens", F.hash("pieces")), F.lit(groups)))
    schema = f"`{id_col}` long, start long, length long, {payload} {kind}, doc_tokens long, sequence_id long, offset long"
    return dealt.groupBy("g").applyInPandas(run, schema)


def pack_documents(docs: DataFrame, tokenizer_path: str, id_col: str = "doc_id", text_col: str = "text", end_id: int = 1, capacity: int = 2048, group_docs: int = 8192, payload: str = "ids", keep_words: bool = True) -> DataFrame:
    """Tokenize and pack; see ``tokenize`` and ``pack``. Only the id and text columns are read."""
    return pack(tokenize(docs, tokenizer_path, id_col, text_col, end_id, capacity, payload, keep_words), docs.count(), capacity, group_docs, id_col, payload)


def sequences(pieces: DataFrame, capacity: int = 2048, pad_id: int = 0, ids: str = "ids") -> DataFrame:
    """(sequence_id, tokens, ids): the packed sequences of pieces that carry their ids.

    They are padded to ``capacity``, but for those of as many tokens as a power of two, which stay as they are.
    """
    rows = F.sort_array(F.collect_list(F.struct("offset", ids)))
    whole = F.aggregate(rows, F.lit(b""), lambda a, x: F.concat(a, x[ids]))
    pad = F.lit(np.array([pad_id], "<u4").tobytes())
    out = pieces.groupBy("sequence_id").agg(F.sum("length").alias("tokens"), whole.alias("ids"))
    pads = F.aggregate(F.array_repeat(pad, F.when(F.bit_count("tokens") == 1, 0).otherwise(F.lit(capacity) - F.col("tokens")).cast("int")), F.lit(b""), lambda a, x: F.concat(a, x))
    return out.withColumn("ids", F.concat("ids", pads))
