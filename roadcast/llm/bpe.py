"""BPE encoding and decoding by forced boundaries.

Two bytes that stand side by side in no vocabulary entry can never end up in one token,
whatever is merged around them: between them lies a certain cut. A word is therefore cut
at all such pairs, every distinct fragment is merged by itself (with the word-end mark only
if it ends its word), and the ids of a text are the ids of its fragments in a row. Words
are those of the tokenizer's own normalizer and pattern. Texts of ASCII and the Latin-1
letters are folded and cut into words with byte tables over whole batches; any other text,
and a tokenizer with another pattern, goes through the library's normalizer and pattern.
Special tokens that stand in a text are their ids, as in the library.

Decoding puts the entries of the ids together the way the tokenizer's decoder does: in a
row as bytes (byte-level decoder) or with spaces between (no decoder). Special tokens stay.

Defined cases: a null or empty text, and one of white space only where the tokenizer drops
it, has no ids and decodes to the empty text; long texts are whole; repeated rows give
repeated results; a null id stays null; an empty table gives an empty result. Other
columns are ignored.
"""

from __future__ import annotations

import hashlib
import json
import os
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from roadcast.llm.common import kept, regrouped

BATCH_BYTES = 2 << 20
#: A worker forgets its words when it holds more of them, or more bytes of them.
MEMO_WORDS, MEMO_BYTES = 400_000, 8 << 20

SPACE, LETTER, DIGIT, OTHER = range(4)
LATIN = 0xC3  # leads the UTF-8 of U+00C0 to U+00FF
SIGNS = (0x97, 0xB7)  # the multiplication and division signs among them
APOSTROPHE = ord("'")
#: The normalizer and pattern that the byte tables stand for.
TABLE_NORMALIZER = ["NFC", "Replace", "Lowercase"]
TABLE_PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
CONTRACTIONS = ("s", "t", "m", "d", "re", "ve", "ll")


def byte_characters() -> list[str]:
    """The character by which byte-level vocabularies write each byte: printable ones as they are, others from U+0100."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    chars = {b: chr(b) for b in shown}
    for byte in range(256):
        chars.setdefault(byte, chr(0x100 + len(chars) - len(shown)))
    return [chars[b] for b in range(256)]


BYTE_TO_CHAR = dict(enumerate(byte_characters()))
CHAR_TO_BYTE = {ord(c): b for b, c in BYTE_TO_CHAR.items()}


def _tables() -> tuple[np.ndarray, np.ndarray]:
    kind = np.full(256, OTHER, np.uint8)
    lower = np.arange(256, dtype=np.uint8)
    for byte in range(128):
        char = chr(byte)
        if char in " \t\n\r\x0b\x0c":
            kind[byte] = SPACE
        elif char.isalpha():
            kind[byte], lower[byte] = LETTER, ord(char.lower())
        elif char.isdigit():
            kind[byte] = DIGIT
    return kind, lower


KIND, LOWER = _tables()


def table_words(raw: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Folded bytes, the starts of words and of the space between them, and whether each is a word.

    ``raw`` holds ASCII and Latin-1 letters in UTF-8 only.
    """
    lead = raw == LATIN
    second = np.zeros(len(raw), bool)
    second[1:] = lead[:-1]
    low = LOWER[raw]
    low[second & (raw <= 0x9E) & (raw != SIGNS[0])] += 0x20
    kind = KIND[raw]
    at = np.flatnonzero(lead)
    latin = np.where(np.isin(raw[at + 1], SIGNS), OTHER, LETTER)
    kind[at] = latin
    kind[at + 1] = latin
    first = np.ones(len(raw), bool)
    first[1:] = (kind[1:] != kind[:-1]) | (kind[1:] == DIGIT)
    quotes = np.flatnonzero((low == APOSTROPHE) & first)
    if len(quotes):
        padded = np.append(low, np.zeros(2, np.uint8))
        for ending in CONTRACTIONS:
            found = np.ones(len(quotes), bool)
            for i, char in enumerate(ending, 1):
                found &= padded[quotes + i] == ord(char)
            first[quotes[found] + 1] = False
            after = quotes[found] + 1 + len(ending)
            first[after[after < len(first)]] = True
    starts = np.flatnonzero(first)
    return low, starts, kind[starts] != SPACE


def never_joined(vocabulary: list[bytes]) -> np.ndarray:
    """For each pair of bytes (first times 256 plus second), whether no entry has the two side by side."""
    forced = np.ones(1 << 16, bool)
    flat = np.frombuffer(b"".join(vocabulary), np.uint8).astype(np.int64)
    pairs = flat[:-1] * 256 + flat[1:]
    inside = np.ones(len(flat), bool)
    inside[np.cumsum([len(e) for e in vocabulary]) - 1] = False
    forced[pairs[inside[:-1]]] = False
    return forced


def ragged(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """The positions of all runs ``starts[i] : starts[i] + lengths[i]`` in a row."""
    ends = np.cumsum(lengths)
    total = int(ends[-1]) if len(ends) else 0
    return np.repeat(starts - (ends - lengths), lengths) + np.arange(total)


class ForcedBoundaryBPE:
    """Encodes and decodes batches of texts with a byte-level BPE tokenizer file."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark runs one task a core
        from tokenizers import Tokenizer, models

        with open(path, encoding="utf-8") as source:
            spec = json.load(source)
        model, added = spec["model"], spec["added_tokens"]
        if model["type"] != "BPE" or any(model[k] for k in ("dropout", "continuing_subword_prefix", "ignore_merges", "byte_fallback")):
            raise ValueError(f"{path}: not a plain BPE tokenizer")
        if any(t[k] for t in added for k in ("single_word", "lstrip", "rstrip", "normalized")):
            raise ValueError(f"{path}: special tokens with rules of their own")
        if spec["decoder"] is not None and spec["decoder"]["type"] != "ByteLevel":
            raise ValueError(f"{path}: unknown decoder")
        self.library = Tokenizer.from_file(path)
        self.suffix = model["end_of_word_suffix"] or ""
        self.specials = {t["content"]: t["id"] for t in added}
        steps = (spec["normalizer"] or {}).get("normalizers", [])
        pattern = (spec["pre_tokenizer"] or {}).get("pretokenizers", [{}])[0].get("pattern", {}).get("Regex")
        self.by_tables = [s["type"] for s in steps] == TABLE_NORMALIZER and pattern == TABLE_PATTERN
        plain = {e: i for e, i in model["vocab"].items() if e not in self.specials}
        self.forced = never_joined([self._bytes(e.removesuffix(self.suffix)) for e in plain])
        merges = [tuple(m) if isinstance(m, list) else tuple(m.split(" ")) for m in model["merges"]]
        own = {"vocab": model["vocab"], "merges": merges, "cache_capacity": 0}
        self.inner = Tokenizer(models.BPE(**own))
        self.last = Tokenizer(models.BPE(**own, end_of_word_suffix=self.suffix)) if self.suffix else self.inner
        self._prepare_decoder({**model["vocab"], **self.specials}, spec["decoder"])
        self._forget()

    @staticmethod
    def _bytes(entry: str) -> bytes:
        return entry.translate(CHAR_TO_BYTE).encode("latin-1")

    # --- decoding ---

    def _prepare_decoder(self, ids: dict[str, int], decoder: dict | None) -> None:
        self.entries = [b""] * (max(ids.values()) + 1)
        for entry, number in ids.items():
            as_bytes = decoder is not None and all(ord(c) in CHAR_TO_BYTE for c in entry)
            self.entries[number] = self._bytes(entry) if as_bytes else entry.encode()
        self.between = b" " if decoder is None else b""

    def decode(self, ids: np.ndarray) -> bytes:
        """The decoded text in UTF-8; bytes that are no UTF-8 become U+FFFD. Ids outside the vocabulary are skipped."""
        known = len(self.entries)
        whole = self.between.join([self.entries[i] for i in ids.tolist() if i < known])
        return whole if self.between else whole.decode("utf-8", "replace").encode()

    # --- encoding ---

    def _forget(self) -> None:
        self.places: dict[bytes | str, int] = {}
        self.held = 0
        self.ids = np.empty(0, np.uint32)
        self.starts = np.empty(0, np.int64)
        self.lengths = np.empty(0, np.int64)

    def _remember(self, keys: list, ids: np.ndarray, lengths: np.ndarray) -> None:
        self.starts = np.concatenate([self.starts, len(self.ids) + np.cumsum(lengths) - lengths])
        self.lengths = np.concatenate([self.lengths, lengths])
        self.ids = np.concatenate([self.ids, ids])
        self.places.update(zip(keys, range(len(self.places), len(self.places) + len(keys)), strict=True))
        self.held += sum(map(len, keys))

    def _merged(self, fragments: pa.BinaryArray, tokenizer) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Ids of the distinct fragments, their starts and lengths, in the order of ``fragments``."""
        coded = fragments.dictionary_encode()
        names = [f.decode("latin-1").translate(BYTE_TO_CHAR) for f in coded.dictionary.to_pylist()]
        found = [e.ids for e in tokenizer.encode_batch_fast(names, add_special_tokens=False)]
        lengths = np.fromiter(map(len, found), np.int64, len(found))
        flat = np.fromiter(chain.from_iterable(found), np.uint32, int(lengths.sum()))
        at = coded.indices.to_numpy()
        return flat, (np.cumsum(lengths) - lengths)[at], lengths[at]

    def _learn(self, words: list[bytes]) -> None:
        raw = np.frombuffer(b"".join(words), np.uint8)
        sizes = np.fromiter(map(len, words), np.int64, len(words))
        word_starts = np.cumsum(sizes) - sizes
        cut = np.zeros(len(raw), bool)
        cut[1:] = self.forced[raw[:-1].astype(np.int64) * 256 + raw[1:]]
        cut[word_starts] = True
        starts = np.flatnonzero(cut)
        ends = np.append(starts[1:], len(raw))
        final = np.isin(ends, word_starts + sizes, assume_unique=False)
        lengths = np.empty(len(starts), np.int64)
        at = np.empty(len(starts), np.int64)
        flats, base = [], 0
        for chosen, tokenizer in ((final, self.last), (~final, self.inner)):
            flat, begin, count = self._merged(slices(raw, starts[chosen], ends[chosen]), tokenizer)
            at[chosen], lengths[chosen] = begin + base, count
            flats.append(flat)
            base += len(flat)
        ids = np.concatenate(flats)[ragged(at, lengths)]
        self._remember(words, ids, np.add.reduceat(lengths, np.searchsorted(starts, word_starts)))

    def _places_of(self, keys: list) -> np.ndarray:
        new = [k for k in dict.fromkeys(k for k in keys if k not in self.places)]
        special = [k for k in new if isinstance(k, str)]
        if special:
            self._remember(special, np.array([self.specials[k] for k in special], np.uint32), np.ones(len(special), np.int64))
        words = [k for k in new if isinstance(k, bytes)]
        if words:
            self._learn(words)
        return np.fromiter(map(self.places.__getitem__, keys), np.int64, len(keys))

    def _library_words(self, text: str) -> list[bytes | str]:
        """Words of any text: bytes, and special tokens as ``str``."""
        words: list[bytes | str] = []
        parts = [text]
        for special in sorted(self.specials, key=len, reverse=True):
            parts = [p for part in parts for p in ([part] if part in self.specials else split_keeping(part, special))]
        for part in parts:
            if part in self.specials:
                words.append(part)
            elif part:
                folded = self.library.normalizer.normalize_str(part) if self.library.normalizer else part
                words += [self._bytes(w) for w, _ in self.library.pre_tokenizer.pre_tokenize_str(folded)]
        return words

    def encode(self, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """``(ids, bounds)``: the text in UTF-8 number ``i`` has ``ids[bounds[i] : bounds[i + 1]]``."""
        if len(self.places) > MEMO_WORDS or self.held > MEMO_BYTES:
            self._forget()
        tabled = self._tabled(texts)
        docs, places = [], []
        at = np.flatnonzero(tabled)
        if len(at):
            raw = np.frombuffer(b"\n".join([texts[i] for i in at]) + b"\n", np.uint8)
            low, starts, is_word = table_words(raw)
            sizes = np.fromiter((len(texts[i]) + 1 for i in at), np.int64, len(at))
            ends = np.append(starts[1:], len(low))[is_word]
            starts = starts[is_word]
            coded = slices(low, starts, ends).dictionary_encode()
            found = self._places_of(coded.dictionary.to_pylist())
            docs.append(at[np.searchsorted(np.cumsum(sizes), starts, side="right")])
            places.append(found[coded.indices.to_numpy()])
        for i in np.flatnonzero(~tabled):
            found = self._places_of(self._library_words(texts[i].decode()))
            docs.append(np.full(len(found), i))
            places.append(found)
        doc = np.concatenate([np.empty(0, np.int64), *docs])
        place = np.concatenate([np.empty(0, np.int64), *places])
        if len(docs) > 1:
            order = np.argsort(doc, kind="stable")
            doc, place = doc[order], place[order]
        lengths = self.lengths[place]
        counts = np.bincount(doc, weights=lengths, minlength=len(texts)).astype(np.int64)
        return self.ids[ragged(self.starts[place], lengths)], np.concatenate(([0], np.cumsum(counts)))

    def encode_ended(self, texts: list[str | None], end_id: int) -> tuple[np.ndarray, np.ndarray]:
        """``encode`` with ``end_id`` behind every text. Null is empty."""
        ids, bounds = self.encode([(t or "").encode() for t in texts])
        return np.insert(ids, bounds[1:], np.uint32(end_id)), bounds + np.arange(len(bounds))

    def _tabled(self, texts: list[bytes]) -> np.ndarray:
        """Which texts the byte tables can cut."""
        if not self.by_tables or not texts:
            return np.zeros(len(texts), bool)
        raw = np.frombuffer(b"\n".join(texts) + b"\n", np.uint8)
        rare = raw >= 0x80
        lead = raw == LATIN
        rare[1:] &= ~lead[:-1]
        rare &= ~lead
        sizes = np.fromiter((len(t) + 1 for t in texts), np.int64, len(texts))
        any_rare = np.logical_or.reduceat(rare, np.cumsum(sizes) - sizes)
        special = [any(s.encode() in t for s in self.specials) for t in texts]
        return ~(any_rare | np.array(special, bool))


def slices(raw: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> pa.LargeBinaryArray:
    """The byte strings ``raw[starts[i] : ends[i]]``, which follow one another without overlap."""
    lengths = ends - starts
    if len(starts) and int(lengths.sum()) != len(raw):
        raw = raw[ragged(starts, lengths)]
    offsets = np.concatenate(([0], np.cumsum(lengths))).astype(np.int64)
    data = raw if len(starts) else np.empty(0, np.uint8)
    return pa.LargeBinaryArray.from_buffers(
        pa.large_binary(), len(starts), [None, pa.py_buffer(offsets), pa.py_buffer(np.ascontiguousarray(data))]
    )


def split_keeping(text: str, mark: str) -> list[str]:
    parts = text.split(mark)
    return [x for part in parts[:-1] for x in (part, mark)] + parts[-1:]


def coder_of(path: str) -> ForcedBoundaryBPE:
    """The coder of this worker process; it outlives a task."""
    return kept(("fragments", path), lambda: ForcedBoundaryBPE(path))


RESULT = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string"


def coded(
    docs: DataFrame, tokenizer_path: str, keep: bool = False, id_column: str = "doc_id", text_column: str = "text"
) -> DataFrame:
    """Encode every text and decode its ids again: ``doc_id, n_tokens, ids_sha256, decoded_sha256``.

    ``keep`` adds ``ids`` (little-endian unsigned 32-bit integers) and ``decoded`` (text).
    """
    fields = [("doc_id", pa.int64()), ("n_tokens", pa.int64()), ("ids_sha256", pa.string()), ("decoded_sha256", pa.string())]
    schema = pa.schema(fields + [("ids", pa.binary()), ("decoded", pa.string())] * keep)

    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = coder_of(tokenizer_path)
        for batch in regrouped(batches, "text", BATCH_BYTES):
            texts = batch.column("text").fill_null(b"").to_pylist()
            ids, bounds = coder.encode(texts)
            raw = memoryview(ids.astype("<u4").tobytes())
            bounds = bounds.tolist()
            parts = [raw[4 * a : 4 * b] for a, b in zip(bounds, bounds[1:], strict=False)]
            decoded = [coder.decode(ids[a:b]) for a, b in zip(bounds, bounds[1:], strict=False)]
            columns = [
                batch.column("doc_id"),
                pa.array([len(p) // 4 for p in parts], pa.int64()),
                pa.array([hashlib.sha256(p).hexdigest() for p in parts], pa.string()),
                pa.array([hashlib.sha256(d).hexdigest() for d in decoded], pa.string()),
            ]
            if keep:
                columns += [pa.array(map(bytes, parts), pa.binary()), pa.array([d.decode() for d in decoded], pa.string())]
            yield pa.RecordBatch.from_arrays(columns, schema=schema)

    rows = docs.select(F.col(id_column).cast("long").alias("doc_id"), F.encode(F.col(text_column), "UTF-8").alias("text"))
    return rows.mapInArrow(of, RESULT + ", ids binary, decoded string" * keep)


def decoded(rows: DataFrame, tokenizer_path: str, id_column: str = "doc_id", ids_column: str = "ids") -> DataFrame:
    """The text of stored ids (as ``coded`` keeps them): ``doc_id, text``. Null ids are no ids."""
    schema = pa.schema([("doc_id", pa.int64()), ("text", pa.string())])

    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = coder_of(tokenizer_path)
        for batch in regrouped(batches, "ids", BATCH_BYTES):
            texts = [coder.decode(np.frombuffer(x or b"", "<u4")).decode() for x in batch.column("ids").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(texts, pa.string())], schema=schema)

    columns = (F.col(id_column).cast("long").alias("doc_id"), F.col(ids_column).cast("binary").alias("ids"))
    return rows.select(*columns).mapInArrow(of, "doc_id long, text string")
