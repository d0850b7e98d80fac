"""Token ids of a public tokenizer whose tokens never span white space.

The vocabulary `word_bpe_49k.json` drops white space and never joins what it separates, so
the ids of a text are those of its words, one after the other. A worker keeps the ids of the
words it has met (at most `KEPT`), which spares most of the work on real text. Words of Latin-1
characters, which no normalisation changes but lower-casing, are cut by the vocabulary's own
rule and given to its merges; every other word takes the tokenizer's whole path.
"""

from __future__ import annotations

import re
import struct
from functools import lru_cache

import public_tokenizers
from tokenizers import Tokenizer

from tallyhouse.llm.words import encoded, words_of

VOCABULARY = "word_bpe_49k.json"
KEPT, KEPT_PARTS = 300_000, 700_000
END = struct.pack("<I", 1)
ID_BYTES = 4

PLAIN = re.compile("[\x21-\x7e\xa1-\xff]+")
# Fixed value: the vocabulary's own cutting rule, with its classes spelt out for Latin-1.
PARTS = re.compile(
    "'s|'t|'re|'ve|'m|'ll|'d|[a-zªµºß-öø-ÿ]+|[0-9²³¹¼½¾]|[^\\sa-zªµºß-öø-ÿ0-9²³¹¼½¾]+"
)


def byte_letters() -> list[str]:
    """The letter that stands for each byte: itself if it is visible, else the next free one."""
    visible = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = sorted(set(range(256)) - set(visible))
    return [chr(b) if b in visible else chr(256 + hidden.index(b)) for b in range(256)]


class WordIds(dict):
    """Ids of words as little-endian 32-bit numbers, worked out at first sight."""

    def __init__(self, path: str):
        super().__init__()
        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = False
        self.model = self.tokenizer.model
        self.letters = byte_letters()
        self.parts: dict[str, bytes] = {}

    def __missing__(self, word: bytes) -> bytes:
        if len(self) >= KEPT:
            self.clear()
        text = word.decode("utf-8", "replace")
        if PLAIN.fullmatch(text) and "<|" not in text:
            ids = b"".join(map(self.part, PARTS.findall(text.lower())))
        else:
            found = self.tokenizer.encode(text, add_special_tokens=False).ids
            ids = struct.pack(f"<{len(found)}I", *found)
        self[word] = ids
        return ids

    def part(self, part: str) -> bytes:
        ids = self.parts.get(part)
        if ids is None:
            if len(self.parts) >= KEPT_PARTS:
                self.parts.clear()
            found = self.model.tokenize("".join(self.letters[b] for b in part.encode()))
            ids = self.parts[part] = struct.pack(f"<{len(found)}I", *(t.id for t in found))
        return ids


@lru_cache(maxsize=1)
def word_ids(path: str | None = None) -> WordIds:
    """One per worker process; path None is the installed public vocabulary."""
    return WordIds(path or public_tokenizers.path(VOCABULARY))


def document_ids(text: str | None, ids: WordIds) -> bytes:
    """Ids of a whole text and the closing id 1, four bytes each."""
    return b"".join(map(ids.__getitem__, words_of(encoded(text)))) + END
