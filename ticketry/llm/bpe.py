"""BPE encoding and decoding of whole texts with reuse of content-defined chunks.

A rolling hash of the last bytes cuts each text where the content says so, so documents that share a passage share the
chunks inside it. A chunk that a worker has met is not encoded again. A cut usually falls inside a word, so both ends of a
chunk are wrong in their encoding; the join of two chunks is repaired by encoding it anew, from the last white space of
the left chunk to the first of the right one. This tokenizer drops white space before it splits a text, so no token
reaches over it and from there outwards the joined encoding agrees exactly with that of the whole text. A chunk without
white space widens the join by the whole chunk, until there is some or the text ends.

The tokenizer lower-cases a text and cuts it into runs of letters, single digits and runs of other characters; merges stay
inside such a piece. So a piece is merged once per worker and serves every word that holds it, in either case and beside
any punctuation. Pieces are cut here where each character stands for itself (most Latin and Cyrillic letters, ASCII, common
punctuation, as the tokenizer's own parts say); a word with any other character, or with a special token, goes to the library whole.

Chunks and pieces are kept per worker, in memory of a fixed bound, so texts never cross a shuffle and a lost executor
costs only its own tasks.

Defined cases: null text is encoded as an empty one (no ids); repeated rows come out as often; any other column is kept
by ``encode`` unless its name is one of the results', which replace it; an empty table gives no rows.
"""

from __future__ import annotations

import hashlib
import json
import re
import struct
import unicodedata
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ticketry.llm.common import give_back, small_batches

RESULT = "n_tokens long, ids_sha256 string, decoded_sha256 string"
BLANKS = b" \t\n\r\x0b\x0c"
#: Characters that may be cut into pieces here; the tokenizer is asked about each.
ASKED = [chr(c) for a, b in ((0x21, 0x7F), (0xA1, 0x250), (0x400, 0x530), (0x2010, 0x2028)) for c in range(a, b)]
PIECES = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
#: How a tokenizer must change and cut texts for it; with another one, all words go to the library.
NORMALIZER = {"type": "Sequence", "normalizers": [
    {"type": "NFC"}, {"type": "Replace", "pattern": {"Regex": r"\s+"}, "content": " "}, {"type": "Lowercase"}]}
PRE_TOKENIZER = {"type": "Sequence", "pretokenizers": [
    {"type": "Split", "pattern": {"Regex": PIECES}, "behavior": "Removed", "invert": True},
    {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": False}]}
_PRIME, _GOLDEN = 0x9E3779B97F4A7C55, np.uint64(0x9E3779B97F4A7C15)


class RollingCuts:
    """Cut positions of a byte string, each decided by the hash of the ``window`` bytes before it."""

    SEGMENT = 1 << 18

    def __init__(self, bits: int = 10, window: int = 24, least: int = 128) -> None:
        self.window, self.least, self.shift = window, least, np.uint64(64 - bits)
        inverse = pow(_PRIME, -1, 1 << 64)
        n = self.SEGMENT + window
        with np.errstate(over="ignore"):
            self.power = np.cumprod(np.array([1, *[_PRIME] * n], np.uint64))
            self.inverse = np.cumprod(np.array([1, *[inverse] * n], np.uint64))

    def __call__(self, data: bytes) -> list[int]:
        """Ascending cut positions, without 0 and the end; never inside a UTF-8 character, ``least`` bytes apart."""
        raw, w, cuts, last = np.frombuffer(data, np.uint8), self.window, [], 0
        for start in range(0, max(0, len(raw) - w), self.SEGMENT):
            part = raw[start:start + self.SEGMENT + w]
            n = len(part)
            with np.errstate(over="ignore"):
                sums = np.cumsum(part.astype(np.uint64) * self.inverse[:n])
                rolled = (sums[w:] - sums[:-w]) * self.power[w:n] * _GOLDEN
            # rolled[i] covers part[i + 1 .. i + w], so the cut stands after byte i + w
            for at in (np.nonzero(rolled >> self.shift == 0)[0] + (start + w + 1)).tolist():
                while at < len(raw) and raw[at] & 0xC0 == 0x80:
                    at += 1
                if at - last >= self.least and at < len(raw):
                    cuts.append(at)
                    last = at
        return cuts


class PieceCuts:
    """Cuts words into the pieces that the tokenizer's normalizer and word pattern make of them."""

    def __init__(self, tokenizer, tokenizer_json: str) -> None:
        spec = json.loads(tokenizer_json)
        added = spec.get("added_tokens") or []
        self.special = [t["content"] for t in added]
        self.bytes: dict[int, str] = {}
        kinds: dict[str, list[str]] = {"letter": [], "number": [], "other": []}
        if (spec.get("normalizer"), spec.get("pre_tokenizer")) == (NORMALIZER, PRE_TOKENIZER) and not any(t["normalized"] for t in added):
            for c in ASKED:
                low = c.lower()
                if low in ASKED and not unicodedata.combining(c) and unicodedata.is_normalized("NFC", c) and tokenizer.normalizer.normalize_str(c) == low:
                    ends = [end for _, (_, end) in tokenizer.pre_tokenizer.pre_tokenize_str(f"a{low}!")]
                    kinds["letter" if ends == [2, 3] else "other" if ends == [1, 3] else "number"] += {c, low}
                    self.bytes[ord(low)] = "".join(piece for piece, _ in tokenizer.pre_tokenizer.pre_tokenize_str(low))
        letters, numbers, others = ("".join(map(re.escape, kinds[k])) for k in kinds)
        self.plain = re.compile(rf"[{letters}{numbers}{others} \t\n\r\x0b\x0c]*")
        self.pattern = re.compile(PIECES.replace(r"\p{L}", letters).replace(r"\p{N}", numbers)) if self.bytes else None

    def known(self, text: str) -> bool:
        """Whether all characters stand for themselves and no special token is in between."""
        return self.pattern is not None and self.plain.fullmatch(text) is not None and not any(t in text for t in self.special)

    def __call__(self, data: bytes) -> tuple[list[str], set[str]]:
        """Pieces in order, and those among them that are whole words for the library."""
        text = data.decode()
        if self.known(text):
            return self.pattern.findall(text.lower()), set()
        made, whole = [], set()
        for word in [w.decode() for w in data.split()]:
            if self.known(word):
                made += self.pattern.findall(word.lower())
            else:
                made.append(word)
                whole.add(word)
        return made, whole


class ChunkCoder:
    """Encodes texts to ids (little-endian uint32, as bytes) and decodes them.

    What was met lately is kept, and what was met in the time before; the latter goes when the former is full.
    """

    def __init__(self, tokenizer_json: str, memo_bytes: int = 4 << 20, memo_words: int = 60_000, cuts: RollingCuts | None = None) -> None:
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_str(tokenizer_json)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        n = self.tokenizer.get_vocab_size(with_added_tokens=True)
        self.names = [(self.tokenizer.id_to_token(i) or "").encode() for i in range(n)]
        self.cuts = cuts or RollingCuts()
        self.memo_bytes, self.memo_words = memo_bytes, memo_words
        self.chunks: dict[bytes, tuple | None] = {}
        self.old_chunks: dict[bytes, tuple | None] = {}
        self.pieces = PieceCuts(self.tokenizer, tokenizer_json)
        self.model = self.tokenizer.model
        self.words: dict[str, bytes] = {}
        self.old_words: dict[str, bytes] = {}
        self.held = self.reused = self.encoded = 0

    def _learn(self, words: list[str]) -> None:
        """Encode words that aren't known, all in one call; a token belongs to the word that holds its first character."""
        made = self.tokenizer.encode(" ".join(words), add_special_tokens=False)
        starts = np.cumsum([0, *[len(w) + 1 for w in words]])
        offsets = np.array(made.offsets, np.int64).reshape(-1, 2)[:, 0]
        ends = (4 * np.searchsorted(offsets, starts[1:], "left")).tolist()
        raw = np.array(made.ids, "<u4").tobytes()
        self.words |= {w: raw[a:b] for w, a, b in zip(words, [0, *ends], ends, strict=False)}

    def _merge(self, piece: str) -> bytes:
        ids = [token.id for token in self.model.tokenize(piece.translate(self.pieces.bytes))]
        return struct.pack(f"<{len(ids)}I", *ids)

    def _encode(self, data: bytes) -> bytes:
        """A piece that starts and ends at white space or at the ends of the text."""
        parts, whole = self.pieces(data)
        known, old = self.words, self.old_words
        if new := set(parts).difference(known):
            known |= {w: old[w] if w in old else self._merge(w) for w in new if w in old or w not in whole}
            if new := [w for w in new if w not in known]:
                self._learn(new)
        ids = b"".join([known[w] for w in parts])
        if len(known) > self.memo_words:
            self.words, self.old_words = {}, known
        return ids

    def _chunk(self, chunk: bytes) -> tuple | None:
        """(bytes before the first white space, ids of the middle, bytes after the last); None: no white space."""
        if chunk in self.chunks:
            self.reused += 1
            return self.chunks[chunk]
        if chunk in self.old_chunks:
            self.reused += 1
            return self._hold(chunk, self.old_chunks[chunk])
        self.encoded += 1
        first = next((i for i, b in enumerate(chunk) if b in BLANKS), -1)
        if first < 0:
            return self._hold(chunk, None)
        last = max(chunk.rfind(b) for b in BLANKS)
        return self._hold(chunk, (chunk[:first], self._encode(chunk[first:last]), chunk[last + 1:]))

    def _hold(self, chunk: bytes, made: tuple | None) -> tuple | None:
        self.chunks[chunk] = made
        self.held += len(chunk) + (sum(map(len, made)) if made else 0) + 400
        if self.held > self.memo_bytes:
            self.chunks, self.old_chunks, self.held = {}, self.chunks, 0
        return made

    def encode(self, text: str | None) -> bytes:
        data = (text or "").encode()
        ids, join, start = [], [], 0
        for end in [*self.cuts(data), len(data)]:
            chunk, start = data[start:end], end
            if (made := self._chunk(chunk)) is None:
                join.append(chunk)
                continue
            head, middle, tail = made
            ids += self._encode(b"".join([*join, head])), middle
            join = [tail]
        ids.append(self._encode(b"".join(join)))
        return b"".join(ids)

    def decode(self, ids: bytes) -> bytes:
        """The tokens with one blank between them."""
        names = self.names
        return b" ".join([names[i] for i in np.frombuffer(ids, "<u4").tolist()])


_CODERS: dict[str, ChunkCoder] = {}


def coder(tokenizer_json: str) -> ChunkCoder:
    """The worker's coder for a tokenizer; it lives as long as the worker."""
    key = hashlib.sha256(tokenizer_json.encode()).hexdigest()
    if key not in _CODERS:
        _CODERS[key] = ChunkCoder(tokenizer_json)
    return _CODERS[key]


def tokenizer_text(path: str | None = None) -> str:
    """The tokenizer's file, read on the driver and sent with the tasks.

    Chunk reuse needs a tokenizer that drops white space and whose decoded text is its tokens with blanks between.
    """
    if path is None:
        import public_tokenizers

        path = public_tokenizers.path("word_bpe_49k.json")
    with open(path, encoding="utf-8") as f:
        text = f.read()
    spec = json.loads(text)
    if spec.get("decoder") is not None or spec.get("post_processor") is not None or spec["model"]["type"] != "BPE":
        raise ValueError("a BPE tokenizer without decoder and post-processor is needed")
    return text


def encode(docs: DataFrame, tokenizer: str | None = None, with_ids: bool = True) -> DataFrame:
    """``docs`` without the text, with n_tokens, ids_sha256 and decoded_sha256, and the ids if asked for."""
    small_batches(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(tokenizer_text(tokenizer))
    made = ["n_tokens", "ids_sha256", "decoded_sha256", "ids"]
    keep = [c for c in docs.columns if c not in ("text", *made)]
    kinds = {f.name: f.dataType.simpleString() for f in docs.schema.fields}
    schema = ", ".join([*(f"`{c}` {kinds[c]}" for c in keep), RESULT, *(["ids array<int>"] if with_ids else [])])

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        work = coder(shared.value)
        for frame in frames:
            rows = [work.encode(t) for t in frame.pop("text")]
            frame["n_tokens"] = [len(i) // 4 for i in rows]
            frame["ids_sha256"] = [hashlib.sha256(i).hexdigest() for i in rows]
            frame["decoded_sha256"] = [hashlib.sha256(work.decode(i)).hexdigest() for i in rows]
            if with_ids:
                frame["ids"] = [np.frombuffer(i, "<i4") for i in rows]
            yield frame
        give_back()

    return docs.select(*keep, "text").mapInPandas(run, schema)


def decode(encoded: DataFrame, tokenizer: str | None = None) -> DataFrame:
    """``encoded`` with the text that its ids decode to, special tokens included; null ids give null."""
    shared = encoded.sparkSession.sparkContext.broadcast(tokenizer_text(tokenizer))

    @F.pandas_udf("string")
    def text_of(ids: pd.Series) -> pd.Series:
        work = coder(shared.value)
        return ids.map(lambda x: None if x is None else work.decode(np.asarray(x, "<u4").tobytes()).decode())

    return encoded.withColumn("text", text_of("ids"))


def digests(docs: DataFrame, tokenizer: str | None = None) -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256 per document."""
    return encode(docs.select("doc_id", "text"), tokenizer, with_ids=False)
