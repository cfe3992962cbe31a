"""Encoding whole texts with a public tokenizer file, a library call for many words at once and for each word once.

The fast way is taken only for the one form of tokenizer that it is proved for, which is read from the file: text composed, white space made one
space, lower case, pieces that are runs of letters, single digits, runs of other marks or English endings, and byte-level merges whose last piece of a word ends
in ``</w>``. There the ids of a text are those of its chunks between white space in a row. Arrow splits a batch of texts and numbers its distinct chunks; a worker
remembers words and other pieces of chunks in Arrow and NumPy arrays (beyond ``CACHE``, only those of its last batch); new words of letters alone are merged together
in NumPy by the file's merges (``merges``), long ones go to the library together, and the ends of words among the ids part them again. Texts with characters whose case, composition or white-space rules might differ between the libraries, and those with a special token's
string, go to the library whole; so do all texts under a tokenizer file of any other form.
"""

from __future__ import annotations

import gc
import json
import os
import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from trajlake.llm import merges

#: Pieces that a worker remembers, about 50 bytes each; bytes of text split at once; such splits for which they are looked through once; words in a library call.
CACHE, SLICE, GROUP, CALL = 500_000, 1 << 22, 2, 500

#: Outside of this the fast path is not taken: Latin letters to U+024F without the dotted capital I, general punctuation, the euro sign.
_SURE = "\t\n\x0b\x0c\r -~ -įı-ɏ‐-‧€"
# The form of tokenizer file that the fast path is for.
_NORMALIZER = [{"type": "NFC"}, {"type": "Replace", "pattern": {"Regex": r"\s+"}, "content": " "}, {"type": "Lowercase"}]
#: Marks that may follow a word in a chunk; none begins an English ending.
_MARKS = ".,;:!?&#$*)"
#: The character that stands for each byte at the byte level: itself if it can be seen, else one from U+0100 on; the space parts words.
_HIDDEN = [b for b in range(256) if not (33 <= b < 127 or 161 <= b < 173 or b > 173)]
_LEVEL = {b: chr(256 + k) for k, b in enumerate(_HIDDEN) if b != 32}
_UNITS = np.array([ord(_LEVEL.get(b, chr(b))) for b in range(256)], "<u2")
_PIECES = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"


def _is_word_bpe(form: dict) -> bool:
    normalizer, pieces, model = form.get("normalizer") or {}, form.get("pre_tokenizer") or {}, form.get("model") or {}
    split, *levels = pieces.get("pretokenizers") or [{}]
    return (
        normalizer.get("normalizers") == _NORMALIZER
        and split.get("type") == "Split"
        and (split.get("pattern") or {}).get("Regex") == _PIECES
        and (split.get("behavior"), split.get("invert")) == ("Removed", True)
        and len(levels) == 1
        and levels[0].get("type") == "ByteLevel"
        and levels[0].get("add_prefix_space") is False
        and levels[0].get("use_regex") is False
        and model.get("type") == "BPE"
        and model.get("end_of_word_suffix") == "</w>"
        and not any(model.get(x) for x in ("dropout", "unk_token", "continuing_subword_prefix", "byte_fallback", "ignore_merges"))
    )


def _gather(values: np.ndarray, starts: np.ndarray, sizes: np.ndarray, of: np.ndarray) -> np.ndarray:
    """The values of the pieces ``of``, in a row; piece i has sizes[i] of them from starts[i] on."""
    size = sizes[of]
    at = np.repeat((starts[of] - np.cumsum(size) + size).astype(np.int32), size)
    at += np.arange(len(at), dtype=np.int32)
    return values[at]


def _last_bytes(texts: pa.StringArray, sizes: np.ndarray) -> pa.StringArray:
    """The last sizes[i] bytes of each text, which are letters of their own."""
    offsets = np.frombuffer(texts.buffers()[1], np.int32)[texts.offset : texts.offset + len(texts) + 1]
    data = np.frombuffer(texts.buffers()[2] or b"", np.uint8)
    ends = np.concatenate(([0], np.cumsum(sizes))).astype(np.int32)
    own = _gather(data, offsets[1:] - sizes, sizes, np.arange(len(texts)))
    return pa.StringArray.from_buffers(len(texts), pa.py_buffer(ends), pa.py_buffer(own))


def _merges(model: dict) -> merges.Merges | None:
    """The file's merges at the byte level, if it is one that they are proved for."""
    vocab, pairs = model["vocab"], [p.split(" ") if isinstance(p, str) else p for p in model["merges"]]
    try:
        first, last = ([vocab[_LEVEL.get(b, chr(b)) + end] if b != 32 else 0 for b in range(256)] for end in ("", model["end_of_word_suffix"]))
        made = [(vocab[a], vocab[b], vocab[a + b]) for a, b in pairs]
        table = np.array(made, np.int64).reshape(-1, 3)
        return merges.Merges(np.array(first), np.array(last), table[:, :2], table[:, 2])
    except (KeyError, ValueError):
        return None


@dataclass
class Split:
    """A batch of texts: which go the fast way, the ids of the others as bytes, and of the first the distinct chunks, all chunks by number, and where each text's are."""

    sure: np.ndarray
    others: list[bytes]
    chunks: pa.StringArray
    of: np.ndarray
    offsets: np.ndarray


class ChunkEncoder:
    """``encode_batch`` gives the ids of an Arrow array of texts in a row, and how many each text has; null counts as empty."""

    def __init__(self, path: str) -> None:
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer, pre_tokenizers

        self._library = Tokenizer.from_file(path)
        with open(path, encoding="utf-8") as f:
            form = json.load(f)
        self.fast = _is_word_bpe(form)
        # The pieces known, first the empty one, and where their ids are in a row of ids.
        self._known = pa.array([""], pa.string())
        self._start, self._size, self._ids = np.zeros(1, np.int64), np.zeros(1, np.int64), np.zeros(0, "<u4")
        if self.fast:
            special = [re.escape(x["content"]) for x in form.get("added_tokens") or []]
            self._unsure = "|".join([f"[^{_SURE}]", *special])
            self._words = Tokenizer(self._library.model)  # which both share
            self._words.pre_tokenizer = pre_tokenizers.WhitespaceSplit()
            vocab = self._words.get_vocab()
            self._ends = np.zeros(max(vocab.values()) + 1, bool)
            self._ends[[i for s, i in vocab.items() if s.endswith("</w>")]] = True
        self._merges = _merges(form["model"]) if self.fast else None

    def whole(self, texts: list[str]) -> list[bytes]:
        return [np.array(e.ids, "<u4").tobytes() for e in self._library.encode_batch_fast(texts, add_special_tokens=False)]

    def _of_words(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of words of lower-case letters in a row, and how many each has: many in one call, at the byte level; each ends with the one id that ends a word."""
        line = " ".join(words)
        if not line.isascii():
            line = _UNITS[np.frombuffer(line.encode(), np.uint8)].tobytes().decode("utf-16-le")
        ids = np.array(self._words.encode_batch_fast([line], add_special_tokens=False)[0].ids, "<u4")
        ends = np.flatnonzero(self._ends[ids]) + 1
        if len(ends) == len(words):
            return ids, np.diff(ends, prepend=0)
        return self._of_others(words)

    def _of_others(self, pieces: list[str]) -> tuple[np.ndarray, np.ndarray]:
        own = self.whole(pieces)
        return np.frombuffer(b"".join(own), "<u4"), np.array([len(x) >> 2 for x in own], np.int64)

    def _learn(self, new: pa.StringArray) -> None:
        """Remembers more pieces, in their order."""
        words, ascii_ = (f(new).to_numpy(zero_copy_only=False) for f in (pc.utf8_is_alpha, pc.string_is_ascii))
        ids, size, at = [self._ids], np.zeros(len(new), np.int64), []
        if self._merges:
            length = pc.binary_length(new).to_numpy()
            short = words & (length > 0) & (length <= merges.LONGEST)
            own = np.flatnonzero(short)
            own = own[np.argsort(length[own], kind="stable")]  # words of about one length side by side
            for begin in range(0, len(own), merges.WORDS):
                part = own[begin : begin + merges.WORDS]
                got, size[part] = self._merges.encode(new.take(pa.array(part)))
                ids.append(got)
            at.append(own)
            words, others = words & ~short, ~words
        else:
            others = ~words
        for some, learn, most in ((words & ascii_, self._of_words, CALL), (words & ~ascii_, self._of_words, CALL), (others, self._of_others, len(new))):
            own = np.flatnonzero(some)
            names = new.take(pa.array(own)).to_numpy(zero_copy_only=False).tolist()
            for begin in range(0, len(own), most):
                got, size[own[begin : begin + most]] = learn(names[begin : begin + most])
                ids.append(got)
            at.append(own)
        order = np.concatenate(at)
        start = np.empty(len(new), np.int64)
        start[order] = len(self._ids) + np.cumsum(size[order]) - size[order]
        self._ids, self._start, self._size = np.concatenate(ids), np.concatenate((self._start, start)), np.concatenate((self._size, size))

    def _table(self, chunks: pa.StringArray) -> tuple[np.ndarray, ...]:
        """Ids of the pieces known in a row, where each piece's begin and how many it has, and the two pieces of each chunk. A word and marks after it are two for the tokenizer too."""
        lower = pc.utf8_lower(chunks)
        stems = pc.utf8_rtrim(lower, characters=_MARKS)
        alone = pc.utf8_is_alpha(stems)
        size, whole = pc.binary_length(stems).to_numpy(), pc.binary_length(lower).to_numpy()
        marked = np.flatnonzero(alone.to_numpy(zero_copy_only=False) & (size < whole))
        ends = _last_bytes(lower.take(pa.array(marked)), (whole - size)[marked])
        known = len(self._known)
        words = pc.if_else(alone, stems, lower)
        del lower, stems
        pieces = pa.concat_arrays([self._known, words, ends])
        del words, ends
        pieces = pieces.dictionary_encode()
        self._known, of = pieces.dictionary, pieces.indices.to_numpy()[known:]
        if len(self._known) > known:
            self._learn(self._known.slice(known))
        both = np.zeros((len(chunks), 2), np.int32)
        both[:, 0] = of[: len(chunks)]
        both[marked, 1] = of[len(chunks) :]
        table = self._ids, self._start, self._size, both
        if len(self._known) > CACHE:
            used = np.bincount(of, minlength=len(self._known)) > 0
            used[0] = True
            self._known, used = self._known.filter(pa.array(used)), np.flatnonzero(used)
            self._ids, self._size = _gather(self._ids, self._start, self._size, used), self._size[used]
            self._start = np.cumsum(self._size) - self._size
        return table

    def _split(self, texts: pa.Array) -> tuple[pa.StringArray, np.ndarray, np.ndarray]:
        """Of sure texts without nulls."""
        # A no-break space, the one other white space of sure texts, stays in its chunk, which then goes to the library whole.
        lists = pc.ascii_split_whitespace(texts)
        numbered = lists.flatten().dictionary_encode()
        offsets = lists.offsets.to_numpy()
        return numbered.dictionary, numbered.indices.to_numpy(zero_copy_only=False), offsets - offsets[0]

    def split(self, texts: pa.Array) -> Split:
        """Splits a batch of texts; what isn't for the fast way is encoded at once."""
        texts = pc.fill_null(texts.cast(pa.string()), "")
        sure = np.zeros(len(texts), bool)
        if self.fast:
            sure = pc.invert(pc.match_substring_regex(texts, self._unsure)).to_numpy(zero_copy_only=False)
        if sure.all():
            return Split(sure, [], *self._split(texts))
        return Split(sure, self.whole(texts.filter(pa.array(~sure)).to_pylist()), *self._split(texts.filter(pa.array(sure))))

    def encode_splits(self, splits: list[Split]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """What ``encode_batch`` gives for each of some batches; the words known are looked through once for all of them."""
        ids, start, size, pieces = self._table(pa.concat_arrays([s.chunks for s in splits]))
        begin = 0
        for s in splits:
            both = pieces[begin : begin + len(s.chunks)]
            begin += len(s.chunks)
            sizes = size[both].sum(1)
            ends = np.concatenate(([0], np.cumsum(sizes[s.of])))
            own = _gather(_gather(ids, start, size, both.ravel()), np.cumsum(sizes) - sizes, sizes, s.of)
            counts = np.diff(ends[s.offsets])
            if not s.sure.all():
                ends = 4 * np.cumsum(counts)
                data = own.tobytes()
                parts = np.empty(len(s.sure), object)
                parts[s.sure] = [data[b - 4 * n : b] for b, n in zip(ends.tolist(), counts.tolist(), strict=True)]
                parts[~s.sure] = s.others
                own, counts = np.frombuffer(b"".join(parts), "<u4"), np.array([len(p) >> 2 for p in parts], np.int64)
            yield own, counts

    def encode_batch(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        return next(self.encode_splits([self.split(texts)]))

    def encode(self, text: str | None) -> bytes:
        """One text's ids as little-endian unsigned 32-bit bytes."""
        return self.encode_batch(pa.array([text], pa.string()))[0].tobytes()


def slices(batch: pa.RecordBatch, text: str, most: int = SLICE) -> Iterator[pa.RecordBatch]:
    """The batch in runs of rows whose texts have about ``most`` bytes; a longer text is a run of its own."""
    size = pc.fill_null(pc.binary_length(batch.column(text)), 0).to_numpy(zero_copy_only=False)
    run = np.cumsum(size, dtype=np.int64) // most
    cuts = [0, *(np.flatnonzero(run[1:] != run[:-1]) + 1).tolist(), batch.num_rows]
    for a, b in zip(cuts, cuts[1:], strict=False):
        if b > a:
            yield batch.slice(a, b - a)


_ENCODERS: dict[str, ChunkEncoder] = {}


def encoder(path: str) -> ChunkEncoder:
    """The worker's encoder for a tokenizer file; one at a time, so that a worker in use again holds no more."""
    if path not in _ENCODERS:
        _ENCODERS.clear()
        _ENCODERS[path] = ChunkEncoder(path)
        # What a worker has loaded by now stays, so that collections, which ``give_back`` makes after each file and task, need not look through it again.
        gc.collect()
        gc.freeze()
    return _ENCODERS[path]
