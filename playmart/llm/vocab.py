"""Reading public tokenizer files inside workers.

``Vocabulary`` wraps one ``tokenizers`` file: its own BPE model, its own
pre-tokenizer, the bytes of each token, and a bounded cache.
"""

from __future__ import annotations

import json
import os
import re

# Fixed value: the split that byte-level vocabularies apply before merging.
PRE_TOKEN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
# Characters whose classes are the same in every Unicode version of the last
# decade; a text with others is split by the tokenizer library itself.
UNSETTLED = re.compile(r"[^\x00-\u052f\u2010-\u2064\u20a0-\u20bf\u3001-\u303f]")

# Entries of a generation of a worker cache; two generations bound its memory.
CACHE_ENTRIES = 300_000


class Cache:
    """Bounded cache of two generations: when the new one is full it becomes
    the old one, and what is found in the old one moves to the new."""

    def __init__(self, entries: int = CACHE_ENTRIES):
        self.entries, self.new, self.old = entries, {}, {}

    def get(self, key):
        value = self.new.get(key)
        if value is None:
            value = self.old.get(key)
            if value is not None:
                self.put(key, value)
        return value

    def put(self, key, value):
        if len(self.new) >= self.entries:
            self.old, self.new = self.new, {}
        self.new[key] = value
        return value


def byte_alphabet() -> list[str]:
    """The printable character that byte-level BPE uses for each byte."""
    keep = {*range(33, 127), *range(161, 173), *range(174, 256)}
    out, extra = [], 0
    for b in range(256):
        out.append(chr(b) if b in keep else chr(256 + extra))
        extra += b not in keep
    return out


class Vocabulary:
    """One tokenizer file opened in this process."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        import regex
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        self.model = self.tokenizer.model
        self.split = regex.compile(PRE_TOKEN).findall
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        self.suffix = spec["model"].get("end_of_word_suffix") or ""
        self.specials = [t["content"] for t in spec["added_tokens"]]
        alphabet = byte_alphabet()
        self.to_chars = dict(enumerate(alphabet))
        to_byte = {c: b for b, c in enumerate(alphabet)}
        size = 1 + max([*spec["model"]["vocab"].values(), *(t["id"] for t in spec["added_tokens"])])
        self.token_bytes = [b""] * size
        for token, i in spec["model"]["vocab"].items():
            self.token_bytes[i] = bytes(to_byte[c] for c in token if c in to_byte)
        for t in spec["added_tokens"]:
            self.token_bytes[t["id"]] = t["content"].encode()
        self.cache = Cache()

    def has_special(self, text: str) -> bool:
        """Whether an added token's string occurs in the text."""
        return any(s in text for s in self.specials)

    def merge(self, piece: bytes) -> list[int]:
        """BPE of one byte string, without any pre-splitting."""
        return [t.id for t in self.model.tokenize(piece.decode("latin-1").translate(self.to_chars))]

    def pre_tokens(self, text: str) -> list[str]:
        """The pre-tokens of a text of a byte-level vocabulary."""
        if not UNSETTLED.search(text):
            return self.split(text)
        return [text[a:b] for _, (a, b) in self.tokenizer.pre_tokenizer.pre_tokenize_str(text)]
