"""BPE encoding and decoding with forced boundaries.

Two neighbouring symbols that stand side by side inside no entry of the vocabulary can
never come to lie in one token: every token is an entry, so a token over both would hold
that very pair. Such places are certain cuts. A word is split at them, the fragments are
encoded each by itself, and their ids are joined and remembered by word. The result is that of BPE
over the whole word.

The words of many texts are found, told apart, looked up and encoded together, as arrays. A word of up to 31 bytes is known by all of
its bytes and their number, as four 64-bit integers; a hash of these only says where to look. Longer words aren't remembered.

Reads a tokenizer file of the word-end kind: NFC, white space to blanks, lower case, a
split by pattern, byte-level symbols and a suffix at word ends.

Null text is encoded as the empty text: no ids, empty decoded text. Rows are independent,
so repeated rows and ties need no rule, and an empty table gives an empty result; columns beyond
the text are kept by ``encode``.
"""

from __future__ import annotations

import functools
import hashlib
import heapq
import json
import unicodedata
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from arborlens.llm.common import fresh, in_chunks, mix

#: Words that a worker remembers, some 60 bytes each; beyond that, the half that was met last stays.
CACHE = 400_000
#: Words that are looked up and encoded at once; those of a longer text go in several turns.
AT_ONCE = 250_000
#: 64-bit integers of a word's bytes; the last byte is its length.
LANES = 4
#: Symbols up to which fragments are encoded many at a time; longer ones go one by one over a heap.
SHORT = 64
#: The split pattern that is worked out on arrays for Latin-1 texts without odd numerals or spaces.
KNOWN_SPLIT = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
ODD_LATIN = {chr(x) for x in (*range(0x1C, 0x20), 0x85, 0xA0, 0xB2, 0xB3, 0xB9, 0xBC, 0xBD, 0xBE)}
BLANK, LETTER, DIGIT, SIGN, ODD = range(5)
#: Blanks between and behind texts, so that the bytes after a word can be read with it.
PAD = b"\n" * (8 * LANES + 8)


def kind_of(c: str) -> int:
    """The kind of a Latin-1 character; odd ones are left to the pattern."""
    return ODD if c in ODD_LATIN else BLANK if c.isspace() else LETTER if c.isalpha() else DIGIT if c.isdigit() else SIGN


#: Kinds by byte of UTF-8, and by the second byte after 0xC2 and 0xC3; other leading bytes are odd.
KIND = np.array([kind_of(chr(b)) if b < 128 else ODD if b >= 0xC4 else SIGN for b in range(256)], np.uint8)
KIND_AFTER = np.array([[kind_of(chr(64 * k + b)) if 128 <= 64 * k + b < 256 and 128 <= b < 192 else ODD for b in range(256)] for k in (0, 1)], np.uint8)


def latin_words(data: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """First places and sizes of the words of KNOWN_SPLIT in lower-case UTF-8 that ends with PAD, and the places of odd bytes; texts that hold none of those are split rightly."""
    b = np.frombuffer(data, np.uint8)
    kind = KIND[b]
    lead = np.flatnonzero((b == 0xC2) | (b == 0xC3))
    kind[lead] = kind[lead + 1] = KIND_AFTER[b[lead] - 0xC2, b[lead + 1]]
    begins = np.append(True, kind[1:] != kind[:-1]) | (kind == DIGIT)
    quote = np.flatnonzero(b == ord("'"))
    quote = quote[begins[quote]]  # within a run of signs, it is one of them
    one, two = b[quote + 1], b[quote + 2]
    size = np.where(np.isin(one, list(b"stmd")), 1, 2 * (((one == ord("r")) | (one == ord("v"))) & (two == ord("e")) | (one == ord("l")) & (two == ord("l"))))
    quote, size = quote[size > 0], size[size > 0]
    begins[quote + 1] = False
    begins[quote + size + 1] = True
    places = np.flatnonzero(begins)
    sizes, word = np.diff(places, append=len(b)), kind[places] != BLANK
    return places[word], sizes[word], np.flatnonzero(kind == ODD)


def spread(first: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The places of all runs, one run after another."""
    return np.arange(int(sizes.sum())) + np.repeat(first - np.cumsum(sizes) + sizes, sizes)


def byte_symbols() -> list[str]:
    """The printable character that stands for each byte in byte-level vocabularies: printable Latin-1 ones for themselves, the others in order from code point 256."""
    own = {b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b <= 255}
    others = iter(range(256, 512))
    return [chr(b) if b in own else chr(next(others)) for b in range(256)]


class ForcedBoundaryBpe:
    """Encoder and decoder of one vocabulary file."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model, self.special = spec["model"], {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.end = model["end_of_word_suffix"]
        self.vocab: dict[str, int] = model["vocab"]
        merges = [tuple(m) if isinstance(m, list) else tuple(m.split(" ")) for m in model["merges"]]
        self.rank = {pair: r for r, pair in enumerate(merges)}
        pattern = next(x for x in spec["pre_tokenizer"]["pretokenizers"] if x["type"] == "Split")["pattern"]["Regex"]
        self.find, self.latin = regex.compile(pattern).findall, pattern == KNOWN_SPLIT
        self.stops = regex.compile("|".join(map(regex.escape, sorted(self.special, key=len, reverse=True)))) if self.special else None
        self.by_id = {i: t for t, i in (self.vocab | self.special).items()}
        #: of the words that are remembered: hashes, ascending; lanes; place and number of their ids among all that are remembered; when they were last met
        self.known, self.lanes = np.empty(0, np.uint64), np.empty((LANES, 0), np.uint64)
        self.first, self.count, self.met = (np.empty(0, np.int64) for _ in range(3))
        self.ids, self.turn = np.empty(0, np.uint32), 0
        # units: the symbol of byte b is unit b, and unit 256 + b at the end of a word
        self.units = byte_symbols() + [x + self.end for x in byte_symbols()]
        at = {x: k for k, x in enumerate(self.units)}
        #: for two units, whether any entry of the vocabulary holds them side by side
        self.inside = np.zeros((512, 512), bool)
        for token in self.vocab:
            body = token[: -len(self.end)] if token.endswith(self.end) and len(token) > len(self.end) else token
            parts = [at[c] for c in body]
            if body != token:
                parts[-1] += 256
            self.inside[parts[:-1], parts[1:]] = True
        self.unit_id = np.array([self.vocab[x] for x in self.units], np.int64)
        pairs = sorted((self.vocab[a] << 32 | self.vocab[b], r, self.vocab[a + b]) for (a, b), r in self.rank.items())
        self.pair, self.pair_rank, self.pair_makes = (np.array(x, np.int64) for x in zip(*pairs, strict=True))
        #: for two units, the place of their pair in the list of merges by pair; -1: in none
        self.unit_pair = self._look(np.repeat(self.unit_id, 512), np.tile(self.unit_id, 512)).astype(np.int32).reshape(512, 512)

    def fragments(self, word: str) -> list[tuple[str, ...]]:
        """The word's symbols, split at its certain cuts."""
        units = np.frombuffer(word.encode("utf-8"), np.uint8).astype(np.int64)
        units[-1] += 256
        cuts = (np.flatnonzero(~self.inside[units[:-1], units[1:]]) + 1).tolist()
        return [tuple(self.units[u] for u in units[a:b]) for a, b in zip([0, *cuts], [*cuts, len(units)], strict=True)]

    def _look(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Where the pairs stand in the list of merges by pair; -1: in none."""
        key = a << 32 | b
        at = np.minimum(np.searchsorted(self.pair, key), len(self.pair) - 1)
        return np.where(self.pair[at] == key, at, -1)

    def _encoded(self, data: np.ndarray, places: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The ids of the words at the places, one word after another, and each word's number of ids."""
        units = data[spread(places, sizes)].astype(np.int64)
        first = np.cumsum(sizes) - sizes
        units[first + sizes - 1] += 256
        begins = np.ones(len(units), bool)
        begins[1:] = ~self.inside[units[:-1], units[1:]]
        begins[first] = True
        starts = np.flatnonzero(begins)
        long = np.diff(starts, append=len(units)) > SHORT
        ids, alive = self.unit_id[units], np.ones(len(units), bool)
        self._merge(ids, alive, np.arange(len(units))[~np.repeat(long, np.diff(starts, append=len(units)))], begins, units)
        for a in starts[long].tolist():
            b = int(starts[np.searchsorted(starts, a) + 1]) if a < starts[-1] else len(units)
            got = self._long_fragment(tuple(self.units[u] for u in units[a:b]))
            ids[a : a + len(got)] = got
            alive[a + len(got) : b] = False
        return ids[alive].astype(np.uint32), np.add.reduceat(alive, first, dtype=np.int64)

    def _merge(self, ids: np.ndarray, alive: np.ndarray, at: np.ndarray, begins: np.ndarray, units: np.ndarray) -> None:
        """BPE over many fragments at once: in each round, every fragment merges its leftmost pair of lowest rank.

        at: positions of the symbols that take part; ids and alive change in place.
        """
        none = len(self.pair)
        begin = begins[at]
        last = np.append(begin[1:], True)
        rank = np.full(len(at), none)
        found = np.full(len(at), -1)
        inner = np.flatnonzero(~last)
        found[inner] = self.unit_pair[units[at[inner]], units[at[inner + 1]]]
        rank[inner] = np.where(found[inner] >= 0, self.pair_rank[found[inner]], none)
        while len(at):
            starts = np.flatnonzero(begin)
            best = np.minimum.reduceat(rank, starts)
            sizes = np.diff(starts, append=len(at))
            each = np.repeat(best, sizes)
            if (best == none).any():  # these fragments are done
                keep = each < none
                at, rank, found, begin, last, each = at[keep], rank[keep], found[keep], begin[keep], last[keep], each[keep]
                if not len(at):
                    return
            hit = np.flatnonzero(rank == each)
            number = np.cumsum(begin)[hit]
            hit = hit[np.append(True, number[1:] != number[:-1])]
            ids[at[hit]] = self.pair_makes[found[hit]]
            alive[at[hit + 1]] = False
            last[hit] = last[hit + 1]
            keep = np.ones(len(at), bool)
            keep[hit + 1] = False
            hit = hit - np.arange(len(hit))  # one symbol fewer for each merge before
            at, rank, found, begin, last = at[keep], rank[keep], found[keep], begin[keep], last[keep]
            near = np.zeros(len(at), bool)
            near[hit] = near[hit[~begin[hit]] - 1] = True
            again = np.flatnonzero(near)
            rank[again] = none
            again = again[~last[again]]
            found[again] = self._look(ids[at[again]], ids[at[again + 1]])
            rank[again] = np.where(found[again] >= 0, self.pair_rank[found[again]], none)

    def _long_fragment(self, units: tuple[str, ...]) -> list[int]:
        """BPE of one fragment over a heap of pairs, in n log n steps."""
        n = len(units)
        parts: list[str | None] = list(units)
        left, right = [i - 1 for i in range(n)], [i + 1 if i + 1 < n else -1 for i in range(n)]
        heap = [(r, i, units[i], units[i + 1]) for i in range(n - 1) if (r := self.rank.get((units[i], units[i + 1]))) is not None]
        heapq.heapify(heap)
        while heap:
            _, i, a, b = heapq.heappop(heap)
            j = right[i]
            if parts[i] != a or j < 0 or parts[j] != b:
                continue
            parts[i], parts[j], right[i] = a + b, None, right[j]
            if right[j] >= 0:
                left[right[j]] = i
            for p, q in ((left[i], i), (i, right[i])):
                if p >= 0 and q >= 0 and (r := self.rank.get((parts[p], parts[q]))) is not None:
                    heapq.heappush(heap, (r, p, parts[p], parts[q]))
        return [self.vocab[p] for p in parts if p is not None]

    def _low(self, text: str) -> str:
        text = unicodedata.normalize("NFC", text)
        # the library lower-cases code point by code point: no rule looks at neighbours
        return text.lower() if "\u03a3" not in text else "".join(c.lower() for c in text)

    def _words(self, text: str) -> list[bytes]:
        """The words of any text, by the pattern. Special tokens' strings in it are those tokens, as in the library, and get a blank before them, which no word begins with."""
        words, at = [], 0
        for m in self.stops.finditer(text) if any(x in text for x in self.special) else ():
            words += [*self.find(self._low(text[at : m.start()])), " " + m.group()]
            at = m.end()
        return [w.encode("utf-8") for w in [*words, *self.find(self._low(text[at:]))]]

    def _split(self, texts: list[str]) -> tuple[list[int], list[int], np.ndarray, np.ndarray, np.ndarray]:
        """An order of the texts, the number of words of each in it, the bytes that hold the words, and the words' places and sizes."""
        low = {i: self._low(t).encode("utf-8") for i, t in enumerate(texts) if self.latin and not any(x in t for x in self.special)}
        while True:
            data = b"\n".join(low.values()) + PAD
            places, sizes, odd = latin_words(data)
            ends = np.cumsum([len(x) + 1 for x in low.values()])
            if not len(odd):
                break
            keys = list(low)
            for k in np.unique(np.searchsorted(ends, odd, "right")).tolist():
                del low[keys[k]]
        words = {i: self._words(t) for i, t in enumerate(texts) if i not in low}
        more = np.fromiter((len(w) for x in words.values() for w in x), np.int64)
        flat = np.frombuffer(b"".join([data, *(w for x in words.values() for w in x), PAD]), np.uint8)
        counts = [*np.diff(np.searchsorted(places, ends), prepend=0).tolist(), *map(len, words.values())]
        return [*low, *words], counts, flat, np.concatenate([places, len(data) + np.cumsum(more) - more]), np.concatenate([sizes, more])

    def _told_apart(self, data: np.ndarray, places: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Lanes and hash of each word; of each different word one that stands for it, and for each word the number of its like. Long words get lanes that hold among these words only."""
        eight = np.ndarray(len(data) - 7, "<u8", data, strides=(1,))
        masks = np.array([(1 << 8 * k) - 1 for k in range(9)], np.uint64)
        lanes = np.zeros((LANES, len(places)), np.uint64)
        for k, lane in enumerate(lanes):
            some = np.flatnonzero(sizes > 8 * k)
            lane[some] = eight[places[some] + 8 * k] & masks[np.minimum(sizes[some] - 8 * k, 8)]
        numbers: dict[bytes, int] = {}
        for i in np.flatnonzero(sizes >= 8 * LANES).tolist():
            lanes[:, i] = [numbers.setdefault(data[places[i] : places[i] + sizes[i]].tobytes(), len(numbers)), *[0] * (LANES - 1)]
        lanes[-1] |= np.minimum(sizes, 255).astype(np.uint64) << np.uint64(56)
        hashed = np.zeros(len(places), np.uint64)
        for lane in lanes:
            hashed = mix(hashed * np.uint64(0x9E3779B97F4A7C15) + lane)
        order = np.argsort(hashed)
        new = np.append(True, hashed[order[1:]] != hashed[order[:-1]])
        stands, like = order[new], np.empty(len(places), np.int64)
        like[order] = np.cumsum(new) - 1
        if any((lane[stands[like]] != lane).any() for lane in lanes):  # two words of one hash
            _, stands, like = np.unique(lanes, axis=1, return_index=True, return_inverse=True)
        return lanes, hashed, stands, like.reshape(-1)

    def _ids(self, data: np.ndarray, places: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """As _encoded, with words looked up among those that are remembered."""
        lanes, hashed, stands, like = self._told_apart(data, places, sizes)
        lanes, hashed = lanes.take(stands, 1), hashed[stands]
        at = np.searchsorted(self.known, hashed)
        hit = np.zeros(len(at), bool)
        inside = np.flatnonzero(at < len(self.known))
        hit[inside] = (self.lanes.take(at[inside], 1) == lanes.take(inside, 1)).all(0) & (sizes[stands[inside]] < 8 * LANES)
        first, count = np.empty(len(at), np.int64), np.empty(len(at), np.int64)
        first[hit], count[hit] = self.first[at[hit]], self.count[at[hit]]
        self.turn += 1
        self.met[at[hit]] = self.turn
        if len(miss := np.flatnonzero(~hit)):
            word = stands[miss]
            ids, n = self._encoded(data, places[word], sizes[word])
            first[miss], count[miss] = len(self.ids) + np.cumsum(n) - n, n
            for k in np.flatnonzero(data[places[word]] == ord(" ")).tolist():
                ids[first[miss[k]] - len(self.ids)] = self.special[data[places[word[k]] + 1 : places[word[k]] + sizes[word[k]]].tobytes().decode("utf-8")]
                count[miss[k]] = 1
            self.ids = np.concatenate([self.ids, ids])
        out = self.ids[spread(first[like], count[like])]
        # of words with one hash, only one is remembered
        free = miss[(sizes[stands[miss]] < 8 * LANES) & (hashed[miss] != np.append(self.known, np.uint64(0))[at[miss]])]
        free = free[np.unique(hashed[free], return_index=True)[1]]
        self.known, self.lanes = np.insert(self.known, at[free], hashed[free]), np.insert(self.lanes, at[free], lanes[:, free], 1)
        self.first, self.count, self.met = np.insert(self.first, at[free], first[free]), np.insert(self.count, at[free], count[free]), np.insert(self.met, at[free], self.turn)
        if len(self.known) > CACHE:
            stay = self.met > np.partition(self.met, len(self.met) - CACHE // 2 - 1)[len(self.met) - CACHE // 2 - 1]
            self.known, self.lanes, self.first, self.count, self.met = self.known[stay], self.lanes[:, stay], self.first[stay], self.count[stay], self.met[stay]
            self.ids = self.ids[spread(self.first, self.count)]
            self.first = np.cumsum(self.count) - self.count
        return out, count[like]

    def encode_bytes(self, texts: list[str]) -> list[bytes]:
        """The ids of each text as little-endian 32-bit integers."""
        order, words, data, places, sizes = self._split(texts)
        if not len(places):
            return [b""] * len(texts)
        ids, n = map(np.concatenate, zip(*(self._ids(data, places[a : a + AT_ONCE], sizes[a : a + AT_ONCE]) for a in range(0, len(places), AT_ONCE)), strict=True))
        coded, ends = ids.astype("<u4").tobytes(), (4 * np.append(0, np.cumsum(n))[np.cumsum(words)]).tolist()
        out = dict(zip(order, (coded[a:b] for a, b in zip([0, *ends], ends, strict=False)), strict=True))
        return [out[i] for i in range(len(texts))]

    def encode_many(self, texts: list[str]) -> list[np.ndarray]:
        return [np.frombuffer(x, "<u4") for x in self.encode_bytes(texts)]

    def encode(self, text: str) -> np.ndarray:
        return self.encode_many([text])[0]

    def decode(self, ids: np.ndarray) -> str:
        """The tokens joined by blanks, as for a file that names no decoder."""
        return " ".join(map(self.by_id.__getitem__, ids.tolist()))


@functools.lru_cache(maxsize=2)
def model_of(path: str) -> ForcedBoundaryBpe:
    """The model of a file, loaded once by each Python process, not by each task."""
    return ForcedBoundaryBpe(path)


def encode(docs: DataFrame, vocabulary: str, text: str = "text", ids: str = "token_ids") -> DataFrame:
    """docs without their text column, with the ids of each whole text (array of int) and n_tokens.

    vocabulary: path of the tokenizer file, readable on every executor. Names that clash get a leading underscore.
    """
    kept = [f for f in docs.schema.fields if f.name != text]
    ids, count = fresh([f.name for f in kept], ids), fresh([f.name for f in kept], "n_tokens")
    schema = T.StructType([*kept, T.StructField(count, T.LongType()), T.StructField(ids, T.ArrayType(T.IntegerType()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = model_of(vocabulary)
        for part, texts in in_chunks(batches, text):
            rows = bpe.encode_many([t or "" for t in texts])
            sizes = [len(r) for r in rows]
            values = pa.array(np.concatenate(rows).astype(np.int32) if rows else np.empty(0, np.int32))
            lists = pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32)), values)
            columns = [part.column(part.schema.get_field_index(f.name)) for f in kept]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(sizes, pa.int64()), lists], names=schema.names)

    return docs.select(*[f"`{f.name}`" for f in kept], f"`{text}`").mapInArrow(run, schema)


def round_trip(docs: DataFrame, vocabulary: str, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """For each row its id, the number of tokens and digests of ids and decoded text, without moving the ids."""
    schema = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = model_of(vocabulary)
        for part, texts in in_chunks(batches, text):
            sizes, hashes, decoded = [], [], []
            for ids in bpe.encode_many([t or "" for t in texts]):
                sizes.append(len(ids))
                hashes.append(hashlib.sha256(ids.astype("<u4").tobytes()).hexdigest())
                decoded.append(hashlib.sha256(bpe.decode(ids).encode("utf-8")).hexdigest())
            yield pa.RecordBatch.from_arrays([part.column(0), pa.array(sizes, pa.int64()), pa.array(hashes, pa.string()), pa.array(decoded, pa.string())], names=["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])

    return docs.select(docs[id_col].cast("long").alias("doc_id"), docs[text].alias("text")).mapInArrow(run, schema)
