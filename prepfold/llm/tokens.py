"""Token ids of whole texts with a vocabulary of the tokenizers library.

``tokenizers`` spends its time on words it has seen before. A byte-level BPE
with the usual pattern never joins what stands before a single space with the
space (a token holds white space only alone or as its first character), so
texts can be cut before their spaces and each distinct piece of a batch be
encoded once, by the library's model; numpy then puts the pieces' ids
together. A piece that starts or ends with white space could depend on its
neighbours; a text with such a piece goes to the library whole. A text that
spells an added token (<|endoftext|>) gets that token's id, as in the library's
plain call; such tokens hold no white space, so they lie within one piece.
``tests/llm`` hold the ids against the library's for whole texts.
"""

from __future__ import annotations

import re
from array import array

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Pieces whose ids a worker keeps, the first it meets.
REMEMBERED = 500_000
#: Latin letters (A-Z, and U+00C0 to U+024F but for two signs, in UTF-8), then
#: ASCII marks up to the piece's end: two pre-tokens.
WORD = re.compile(rb"((?:[A-Za-z]|\xc3[\x80-\x96\x98-\xb6\xb8-\xbf]|[\xc4-\xc8][\x80-\xbf]|\xc9[\x80-\x8f])+)"
                  rb"([!-/:-@\[-`{-~]*)")
#: What a part of such a piece can be.
SPELT = re.compile(rb"[^!-/:-@\[-`{-~]*[!-/:-@\[-`{-~]*")
#: Text encoded at a time, and pieces put together at a time.
SLICE_BYTES = 8 << 20
SLICE = 1 << 17


def vocabulary_path() -> str:
    import public_tokenizers
    return public_tokenizers.path("byte_bpe_50k.json")


class Encoder:
    """Encodes texts to little-endian unsigned 32-bit ids."""

    def __init__(self, path: str):
        import os
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")  # Spark has the cores
        from tokenizers import Tokenizer, pre_tokenizers
        self.tokenizer = Tokenizer.from_file(path)
        self.model = self.tokenizer.model
        self.cuts = _cuts_at_spaces(self.tokenizer, pre_tokenizers)
        name_of = pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False).pre_tokenize_str
        # Bytes of a letter's UTF-8 form or of a space, as byte-level vocabularies write them.
        self.names = {b: n for c in range(0xC0, 0x250) for b, n in zip(chr(c).encode(), name_of(chr(c))[0][0])}
        self.names[0x20] = "Ġ"
        # Ids of pieces (in UTF-8) after a space, and of pieces after none.
        self.known: dict[bytes, dict[bytes, bytes]] = {b" ": {}, b"": {}}

    def whole(self, text: str) -> bytes:
        """The library's ids of a text."""
        return array("I", self.tokenizer.encode(text, add_special_tokens=False).ids).tobytes()

    def piece(self, piece: bytes, before: bytes) -> bytes | None:
        """Ids of a piece after ``before`` (a space or nothing); None where
        they depend on what stands beside it."""
        known = self.known[before]
        ids = known.get(piece)
        if ids is None:
            ids = self._made(piece, before)
            if ids is not None and len(known) < REMEMBERED:
                known[piece] = ids
        return ids

    def _made(self, piece: bytes, before: bytes) -> bytes | None:
        own = WORD.fullmatch(piece)
        if own and own[2]:
            return self.piece(own[1], before) + self._other(own[2])
        if own:  # letters, with the space one pre-token
            name = (before + piece).decode("latin-1").translate(self.names)
            return array("I", [t.id for t in self.model.tokenize(name)]).tobytes()
        text = piece.decode()
        if not text or text[0].isspace() or text[-1].isspace():
            return None
        lines = text.split("\n")
        if len(lines) == 1 or any(not x or x[0].isspace() or x[-1].isspace() for x in lines):
            return self.whole(before.decode() + text)
        end = self._other(b"\n")
        return self.piece(lines[0].encode(), before) + b"".join(end + self.piece(x.encode(), b"") for x in lines[1:])

    def _other(self, marks: bytes) -> bytes:
        known = self.known[b""]
        ids = known.get(marks)
        if ids is None:
            ids = known[marks] = self.whole(marks.decode())
        return ids

    def slices(self, column: pa.Array):
        """Runs of about SLICE_BYTES of an Arrow string column (null: empty):
        (first row, ids, where each text's ids start, one more than texts)."""
        column = pc.fill_null(column, "")
        ends = np.cumsum(pc.binary_length(column).to_numpy(zero_copy_only=False).astype(np.int64))
        lo = 0
        while lo < len(column):
            before = int(ends[lo - 1]) if lo else 0
            hi = max(lo + 1, int(np.searchsorted(ends, before + SLICE_BYTES, "right")))
            yield lo, *self.encode(column.slice(lo, hi - lo))
            lo = hi

    def encode(self, column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts of an Arrow string column (null: empty), one after
        the other, and where each text's ids start (one more than texts)."""
        column = pc.fill_null(column, "")
        if not self.cuts:
            return _joined([self.whole(t) for t in column.to_pylist()])
        words = pc.split_pattern(column, " ")
        offsets = words.offsets.to_numpy().astype(np.int64)
        flat = words.values.slice(offsets[0], offsets[-1] - offsets[0]).dictionary_encode()
        offsets = offsets - offsets[0]
        codes, pieces = flat.indices.to_numpy(), _bytes_of(flat.dictionary)
        ids = list(map(self.known[b" "].get, pieces))
        unsafe = np.zeros(len(ids), bool)
        for k, x in enumerate(ids):
            if x is None:
                x = self.piece(pieces[k], b" ")
                unsafe[k] = x is None
                ids[k] = x or b""
        sizes = np.fromiter(map(len, ids), np.int64, len(ids)) // 4
        values = np.frombuffer(b"".join(ids), np.uint32)
        starts = np.cumsum(sizes) - sizes
        # The first piece of a text has no space before it.
        heads = [self.piece(pieces[c], b"") for c in codes[offsets[:-1]].tolist()]
        unsafe_at = np.concatenate([[0], np.cumsum(unsafe[codes])])
        body = unsafe_at[offsets[1:]] - unsafe_at[np.minimum(offsets[:-1] + 1, offsets[1:])]
        out, counts, lo, n = [], [], 0, len(column)
        while lo < n:
            hi = max(lo + 1, int(np.searchsorted(offsets, offsets[lo] + SLICE, "right")) - 1)
            own = codes[offsets[lo]:offsets[hi]]
            size = sizes[own]
            size[offsets[lo:hi] - offsets[lo]] = 0
            ends = np.cumsum(size)
            got = values[np.repeat(starts[own] - (ends - size), size) + np.arange(ends[-1])]
            upto = ends[offsets[lo + 1:hi + 1] - offsets[lo] - 1].tolist()
            at = 0
            for d, end in zip(range(lo, hi), upto):
                if heads[d] is None or body[d]:
                    parts = [np.frombuffer(self.whole(column[d].as_py()), np.uint32)]
                else:
                    parts = [np.frombuffer(heads[d], np.uint32), got[at:end]]
                at = end
                out += parts
                counts.append(sum(map(len, parts)))
            lo = hi
        return _concatenated(out), np.concatenate([[0], np.cumsum(counts, dtype=np.int64)])


def encoder(path: str) -> Encoder:
    """The process's encoder for a vocabulary: a Python worker that runs
    several tasks loads it once and keeps the pieces it has met."""
    import tokenizers
    kept = vars(tokenizers).setdefault("_encoders", {})  # outlives the task's own copy of this module
    if path not in kept:
        kept[path] = Encoder(path)
    return kept[path]


def _bytes_of(column: pa.Array) -> list[bytes]:
    """A string array's values in UTF-8, cut from its own buffers."""
    if not len(column):
        return []
    kind = np.int64 if pa.types.is_large_string(column.type) else np.int32
    offsets = np.frombuffer(column.buffers()[1], kind)[column.offset:column.offset + len(column) + 1].tolist()
    data = column.buffers()[2].to_pybytes() if column.buffers()[2] else b""
    return [data[a:b] for a, b in zip(offsets, offsets[1:])]


def _concatenated(parts: list) -> np.ndarray:
    return np.concatenate(parts) if parts else np.empty(0, np.uint32)


def _joined(encoded: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    ends = np.cumsum([len(x) // 4 for x in encoded], dtype=np.int64)
    return np.frombuffer(b"".join(encoded), np.uint32), np.concatenate([[0], ends])


def _cuts_at_spaces(tokenizer, pre_tokenizers) -> bool:
    """Whether the vocabulary is of the kind the cuts hold for: byte-level with
    its own pattern, no normaliser, no space put before a text."""
    from tokenizers import models
    pre = tokenizer.pre_tokenizer
    return (isinstance(tokenizer.model, models.BPE) and tokenizer.normalizer is None
            and isinstance(pre, pre_tokenizers.ByteLevel) and not pre.add_prefix_space and pre.use_regex
            and not any(t.lstrip or t.rstrip or t.single_word or any(map(str.isspace, t.content))
                        or SPELT.fullmatch(t.content.encode()) for t in tokenizer.get_added_tokens_decoder().values()))
