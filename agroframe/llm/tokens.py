"""Encoding whole texts with a public tokenizer file, inside tasks.

``WordEncoder`` gives exactly the ids that ``tokenizers`` gives for a whole
text.  It encodes each distinct unit once per worker and joins the cached ids.
A unit ends before white space, or between a Latin letter and an ASCII
punctuation mark; neither supported pre-tokenizer ever builds a token across
such a border.  Texts with other white space than blank, tab, line feed and
carriage return, and texts that hold the string of an added token (such as
``<|endoftext|>``, which the tokenizer reads as that token), are handed to it whole.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import public_tokenizers
from tokenizers import Tokenizer

from agroframe.llm.common import worker_cache


_LETTERS = r"[A-Za-zÀ-ÖØ-öø-ʯ]++(?=[!-/:-@\[-`{-~\s]|\Z)"
_UNITS = {"leading": rf"\s*{_LETTERS}|\s*\S+|\s+", "dropped": rf"{_LETTERS}|\S+"}


@dataclass(frozen=True)
class TokenizerFile:
    """A tokenizer file; *spaces*: ``leading`` (kept, opening the next token) or ``dropped``."""

    path: str
    spaces: str
    cached_units: int = 400_000  # kept in a generation, of which a Python worker holds two; results never depend on it


def byte_bpe(cached_units: int = 500_000) -> TokenizerFile:
    return TokenizerFile(public_tokenizers.path("byte_bpe_50k.json"), "leading", cached_units)


def word_bpe(cached_units: int = 400_000) -> TokenizerFile:
    return TokenizerFile(public_tokenizers.path("word_bpe_49k.json"), "dropped", cached_units)


class WordEncoder:
    def __init__(self, file: TokenizerFile):
        self.tokenizer = Tokenizer.from_file(file.path)
        self.added = [a.content for a in self.tokenizer.get_added_tokens_decoder().values()]
        self.dropped = file.spaces == "dropped"
        self.cached_units = file.cached_units
        self.odd_space = re.compile(r"[^\S \n\t\r]").search
        # up to U+024F lower-casing works letter by letter, before or after the tokenizer's own normalizing
        self.not_latin = re.compile("[^\x00-\u024f]").search
        self.units = re.compile(_UNITS[file.spaces]).findall
        vocab = self.tokenizer.get_vocab(with_added_tokens=True)
        self.n_bytes = np.zeros(max(vocab.values()) + 1, dtype=np.int64)
        self.closing = np.zeros(len(self.n_bytes), dtype=bool)
        for token, i in vocab.items():
            self.closing[i] = token.endswith("</w>")
        for token, i in vocab.items():  # byte-level alphabets: one character stands for one byte
            self.n_bytes[i] = len(token.removesuffix("</w>") if self.dropped else token)
        self.cache: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}  # the cache before it was last full

    def _one_by_one(self, texts: list[str]) -> list[bytes]:
        return [np.array(e.ids, dtype="<u4").tobytes()
                for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def _cut(self, line: str, units: list[str], ends_of=None) -> dict[str, bytes]:
        """Encode *line*, made of *units*, in one call and cut its ids where *ends_of* says; {} if it cannot tell."""
        ids = np.array(self.tokenizer.encode_batch_fast([line], add_special_tokens=False)[0].ids, dtype="<u4")
        cut = ends_of(ids)
        if cut is None or len(cut) != len(units) or cut[-1] != len(ids):
            return {}
        data, to = ids.tobytes(), (4 * cut).tolist()
        return dict(zip(units, map(data.__getitem__, map(slice, [0, *to], to))))

    def _by_length(self, parts: list[str]):
        """Units end where the bytes of their tokens add up to theirs."""
        def ends_of(ids: np.ndarray):
            ends = np.cumsum(self.n_bytes[ids])
            unit_ends = np.cumsum(np.fromiter(map(len, map(str.encode, parts)), dtype=np.int64, count=len(parts)))
            cut = np.searchsorted(ends, unit_ends, side="right")
            return cut if len(ends) and (ends[cut - 1] == unit_ends).all() else None

        return ends_of

    def _learn(self, units: list[str]) -> None:
        """Encode new units in few calls."""
        if self.dropped:
            # a word of letters is one pre-token, so its last token closes it
            words = [u for u in units if u.isalpha()]
            others = [u for u in units if not u.isalpha()]
            out = self._cut(" ".join(words), words, lambda ids: np.flatnonzero(self.closing[ids]) + 1) if words else {}
            if others:
                line = " ".join(others)
                out.update(self._cut(line, others, self._by_length(self.tokenizer.normalizer.normalize_str(line).split(" "))))
        else:
            joined = [u for u in units if u[0] in " \n\t\r" and u[-1] not in " \n\t\r"]
            out = self._cut("".join(joined), joined, self._by_length(joined)) if joined else {}
        self.cache.update(out)
        if len(out) < len(units):
            single = [u for u in units if u not in out]
            self.cache.update(zip(single, self._one_by_one(single)))

    def encode(self, texts: list[str]) -> list[bytes]:
        """Ids of each whole text as little-endian unsigned 32-bit integers."""
        if len(self.cache) > self.cached_units:
            self.older, self.cache = self.cache, {}
        held, new = [], {}
        for text in texts:
            t = text
            if self.dropped and not self.not_latin(t):
                t = t.lower()  # the tokenizer does so anyway, except when it looks for added tokens; fewer units to learn
            # the lower case of a dotted capital I has a mark, at which the pre-tokenizer cuts
            whole = self.dropped and "\u0130" in text or self.odd_space(t) or any(a in t for a in self.added)
            units = None if whole else self.units(t)
            got = units and list(map(self.cache.get, units))
            holes = [k for k, v in enumerate(got) if v is None] if got else ()
            new.update((units[k], None) for k in holes)
            held.append((text, units, got, holes))
        for u in new.keys() & self.older.keys():
            self.cache[u] = self.older[u]
            del new[u]
        if new:
            self._learn(list(new))
        out = []
        for text, units, got, holes in held:
            for k in holes:
                got[k] = self.cache[units[k]]
            out.append(self._one_by_one([text])[0] if units is None else b"".join(got))
        return out


def encoder(file: TokenizerFile) -> WordEncoder:
    """The encoder of *file* in this worker, made once and kept across tasks."""
    cache = worker_cache("encoders")
    if file.path not in cache:
        cache[file.path] = WordEncoder(file)
    cache[file.path].cached_units = file.cached_units
    return cache[file.path]


def encode_in_chunks(file: TokenizerFile, texts: list[str | None], chars: int = 500_000) -> Iterator[bytes]:
    """Encode a batch chunk by chunk, so that working memory is bounded by *chars* or one text."""
    enc, chunk, held = encoder(file), [], 0
    for t in texts:
        chunk.append(t or "")
        held += len(chunk[-1])
        if held >= chars:
            yield from enc.encode(chunk)
            chunk, held = [], 0
    if chunk:
        yield from enc.encode(chunk)
