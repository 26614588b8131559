"""Token ids by a public tokenizer, made inside tasks from Arrow batches."""

from __future__ import annotations

import struct
import unicodedata
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa

WORDS_KEPT = 500_000  # memory bound of a worker's table of words, some 100 MB
ROWS = 128


def vocabulary_path(name: str = "word_bpe_49k.json") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def byte_letters() -> dict[int, str]:
    """The visible character that stands for each byte in a byte-level vocabulary."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = [b for b in range(256) if b not in shown]
    return {b: chr(b) for b in shown} | {b: chr(256 + i) for i, b in enumerate(hidden)}


class WordIds:
    """Ids of whole texts through a table of words already seen.

    The tokenizer normalises characters one by one or inside a word, collapses white space and never joins what
    white space separates; so the ids of a text are the ids of its parts between spaces and line feeds.  Most
    parts have been seen before.  A new part that is a Latin word, perhaps with a full stop or comma, is lower-cased
    and goes straight to the merges, which is what the tokenizer does with it after its general steps; every
    other part goes through the whole tokenizer.  A very long text is never one encoding.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.merges = self.tokenizer.model
        self.letters = byte_letters()
        self.marks = {mark: self._whole(mark) for mark in ".,"}
        self.known: dict[str, bytes] = {"": b""}

    def _whole(self, part: str) -> bytes:
        ids = self.tokenizer.encode(part, add_special_tokens=False).ids
        return struct.pack(f"<{len(ids)}I", *ids)

    def _word(self, word: str) -> bytes | None:
        """Ids of a Latin word, None where the general steps could change it."""
        if word.isascii():
            low = shown = word.lower()
        elif max(word) < "\u0250" and unicodedata.is_normalized("NFC", word):
            low = "".join(c.lower() for c in word)
            shown = "".join(self.letters[b] for b in low.encode())
        else:
            return None
        if not low.isalpha():
            return None
        ids = self.known.get(low)
        if ids is None:
            found = [t.id for t in self.merges.tokenize(shown)]
            ids = struct.pack(f"<{len(found)}I", *found)
        return ids

    def _part(self, part: str) -> bytes:
        core, tail = (part[:-1], self.marks[part[-1]]) if part[-1] in self.marks else (part, b"")
        ids = self._word(core) if core.isalpha() else None
        return self._whole(part) if ids is None else ids + tail

    def __call__(self, texts: list[str]) -> Iterator[np.ndarray]:
        known = self.known
        for text in texts:
            extra: dict[str, bytes] = {}
            parts = text.replace("\n", " ").split(" ")
            for part in parts:
                if part not in known and part not in extra:
                    (known if len(known) < WORDS_KEPT else extra)[part] = self._part(part)
            if extra:
                yield np.frombuffer(b"".join([known[p] if p in known else extra[p] for p in parts]), "<u4")
            else:
                yield np.frombuffer(b"".join([known[p] for p in parts]), "<u4")


@lru_cache(maxsize=2)
def word_ids(path: str) -> WordIds:
    """One table a worker, kept between tasks."""
    return WordIds(path)


def text_blocks(batches: Iterator[pa.RecordBatch], rows: int = ROWS, chars: int = 4_000_000) -> Iterator[tuple[pa.RecordBatch, list[str]]]:
    """Blocks of few rows and few characters; column 1 holds the texts."""
    for batch in batches:
        start = 0
        while start < batch.num_rows:
            texts, size = [], 0
            while start + len(texts) < batch.num_rows and len(texts) < rows and size < chars:
                texts.append(batch.column(1)[start + len(texts)].as_py())
                size += len(texts[-1])
            yield batch.slice(start, len(texts)), texts
            start += len(texts)
