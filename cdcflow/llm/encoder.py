"""Token ids of whole texts by the library that belongs to a tokenizer file."""

from __future__ import annotations

import hashlib
import json
import os
from array import array

import numpy as np
from pyspark import Broadcast
from pyspark.sql import SparkSession

#: Largest tokenizer file that is sent to the executors.
MAX_MODEL_BYTES = 64 << 20
#: Bytes of words and ids remembered by one worker, in two halves: when one is full, the older half is dropped.
REMEMBERED_BYTES = 120 << 20
#: What the memory needs for a word beside its letters and ids: two objects and a place in the table.
_ENTRY_BYTES = 170
_LONG_WORD = 64
_MARK = b"\x01"
_BETWEEN = b" " + _MARK + b" "
#: Special strings and the first bytes of combining marks (U+0300 to U+036F).
_CASED = (b"<|", b"\xcc", b"\xcd")
#: What may follow the letters of a word as a piece of its own.
_TAIL = b".,;:!?"

#: A splitter whose pieces never reach over white space and that drops white space (fixed value).
_WORD_PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"


class Tokenizer:
    """A tokenizer file as it travels to the executors: its bytes, kind and digest.

    The digest covers the file and the way it is called, so counts stored under it stay valid until
    either changes.
    """

    CALL = "whole text; no begin, end or added special tokens; special strings as the library's default"

    def __init__(self, spark: SparkSession, path: str):
        with open(path, "rb") as f:
            data = f.read()
        if len(data) > MAX_MODEL_BYTES:
            raise ValueError(f"tokenizer file of {len(data)} bytes; at most {MAX_MODEL_BYTES} are broadcast")
        self.kind = "pieces" if path.endswith(".model") else "json"
        self.digest = hashlib.sha256(self.kind.encode() + b"\0" + self.CALL.encode() + b"\0" + data).hexdigest()
        model = json.loads(data) if self.kind == "json" else {}
        self.by_word = bool(model) and splits_at_space(model)
        self.lower = self.by_word and "Lowercase" in _normalizers(model)
        self.direct = self.by_word and takes_letters(model)
        self.data: Broadcast = spark.sparkContext.broadcast(data)

    def __getstate__(self):
        return {k: self.__dict__[k] for k in ("kind", "digest", "by_word", "lower", "direct", "data")}

    def open(self) -> Encoder:
        """The worker's encoder for this tokenizer, made once per worker."""
        if self.digest not in _OPEN:
            _OPEN.clear()
            _OPEN[self.digest] = Encoder(self.data.value, self.kind, self.by_word, self.lower, self.direct)
        return _OPEN[self.digest]


def _normalizers(model: dict) -> set[str]:
    normal = model.get("normalizer") or {}
    return {x["type"] for x in normal.get("normalizers", [normal] if normal else [])}


def splits_at_space(model: dict) -> bool:
    """Whether ids of a text are the ids of its white-space separated words, one after the other.

    True for models whose pre-tokenizer drops white space between pieces and whose normalizer works
    character by character; all others are given whole texts.
    """
    steps = model.get("pre_tokenizer") or {}
    steps = steps.get("pretokenizers", [steps])
    first = steps[0] if steps else {}
    drops = first.get("type") == "Split" and first.get("behavior") == "Removed" and first.get("invert") is True
    kinds = _normalizers(model)
    plain = not any(t["lstrip"] or t["rstrip"] or t["single_word"] or t["normalized"] for t in model["added_tokens"])
    prefix = any(s.get("add_prefix_space") for s in steps)
    return drops and first["pattern"].get("Regex") == _WORD_PATTERN and kinds <= {"NFC", "Replace", "Lowercase"} and plain and not prefix


def takes_letters(model: dict) -> bool:
    """Whether the model proper sees a word of the letters a-z as it is, so that it can be asked directly.

    For models split as above whose only further step maps bytes to characters (a-z to themselves), and
    whose added tokens are not made of such letters alone.
    """
    rest = (model.get("pre_tokenizer") or {}).get("pretokenizers", [])[1:]
    bytewise = [s.get("type") for s in rest] == ["ByteLevel"] and not rest[0].get("use_regex") and not rest[0].get("add_prefix_space")
    return bytewise and model["model"].get("type") == "BPE" and not any(t["content"].encode().isalpha() for t in model["added_tokens"])


class Encoder:
    """Encodes batches of UTF-8 texts; ids come as little-endian unsigned 32-bit bytes.

    Where the model allows it, words are encoded once and remembered, in a memory of bounded size.
    Very long words are not kept.  With ``lower`` the model ignores case, and A-Z are made small
    beforehand, unless the text holds a special string or a mark that could join a letter (the
    joined letter may exist in one case only).
    """

    def __init__(self, data: bytes, kind: str, by_word: bool, lower: bool = False, direct: bool = False):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        self.by_word, self.lower, self.known, self.older, self.held = by_word, lower, {}, {}, 0
        if kind == "json":
            from tokenizers import Tokenizer as Library

            library = Library.from_buffer(data)
            self.whole = lambda texts: [x.ids for x in library.encode_batch_fast(texts, add_special_tokens=False)]
            self.letters = library.model.tokenize if direct else None
        else:
            from sentencepiece import SentencePieceProcessor

            library = SentencePieceProcessor(model_proto=data)
            self.whole = lambda texts: library.encode(texts, num_threads=1)
            self.letters = None
        self.tails: dict[bytes, bytes] = {b"": b""}
        self.mark = self._raw([_MARK])[0]

    def _raw(self, texts: list[bytes]) -> list[bytes]:
        return [array("I", x).tobytes() for x in self.whole([t.decode("utf-8", "replace") for t in texts])]

    def _tail(self, tail: bytes) -> bytes:
        if tail not in self.tails:
            if len(self.tails) > 1000:
                self.tails = {b"": b""}
            self.tails[tail] = self._raw([tail])[0]
        return self.tails[tail]

    def _new(self, words: list[bytes]) -> dict[bytes, bytes]:
        """Ids of words not known yet.  Letters a-z go straight to the model, what follows them is a piece of its own."""
        if self.letters is None:
            return dict(zip(words, self._words(words), strict=True))
        out, rest = {}, []
        for w in words:
            base = w.rstrip(_TAIL)
            if base.isalpha() and base.islower():
                ids = self.known.get(base) if len(base) < len(w) else None
                out[w] = (ids or array("I", [x.id for x in self.letters(base.decode())]).tobytes()) + self._tail(w[len(base) :])
            else:
                rest.append(w)
        out.update(zip(rest, self._words(rest), strict=True))
        return out

    def _words(self, words: list[bytes]) -> list[bytes]:
        """Ids of many words in a few calls: joined by a mark that is a token of its own."""
        odd = [i for i, w in enumerate(words) if len(w) > _LONG_WORD or _MARK in w or b"<|" in w]
        if odd or len(words) < 16 or len(self.mark) != 4:
            few = set(odd) if len(words) >= 16 and len(self.mark) == 4 else set(range(len(words)))
            out: list[bytes] = [b""] * len(words)
            for i, x in zip(sorted(few), self._raw([words[i] for i in sorted(few)]), strict=True):
                out[i] = x
            rest = [i for i in range(len(words)) if i not in few]
            for i, x in zip(rest, self._words([words[i] for i in rest]) if rest else (), strict=True):
                out[i] = x
            return out
        out = []
        for at in range(0, len(words), 2000):
            ids = np.frombuffer(self._raw([_BETWEEN.join(words[at : at + 2000])])[0], "<u4")
            ends = np.flatnonzero(ids == np.frombuffer(self.mark, "<u4")[0])
            raw, last = ids.tobytes(), 0
            for end in (ends * 4).tolist():
                out.append(raw[last:end])
                last = end + 4
            out.append(raw[last:])
        return out

    def ids(self, texts: list[bytes]) -> list[bytes]:
        if not self.by_word:
            return self._raw(texts)
        split = [(text.lower() if self.lower and not any(x in text for x in _CASED) else text).split() for text in texts]
        missing = set().union(*split).difference(self.known)
        fresh = {w: self.older[w] for w in missing if w in self.older} if self.older else {}
        new = sorted(missing.difference(fresh))
        fresh.update(self._new(new))
        self.known.update(fresh)
        out = [b"".join(map(self.known.__getitem__, words)) for words in split]
        for w in [w for w in new if len(w) > _LONG_WORD]:
            del self.known[w], fresh[w]
        self.held += _ENTRY_BYTES * len(fresh) + sum(map(len, fresh)) + sum(map(len, fresh.values()))
        if self.held > REMEMBERED_BYTES // 2:
            self.known, self.older, self.held = {}, self.known, 0
        return out


_OPEN: dict[str, Encoder] = {}
