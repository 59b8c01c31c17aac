"""Token ids of whole texts with a byte-level BPE vocabulary file.

A text is cut into the vocabulary's own pre-tokens, whose ids are remembered
per worker: natural text repeats most of its words, and only words not seen
before go through the tokenizer.
"""

from __future__ import annotations

import json
import os
import re
import unicodedata
from struct import pack

from lakeload.llm.scratch import worker_cache

#: Distinct pre-tokens of one generation. A Python worker remembers two: words met again move on to the next one.
REMEMBERED = 300_000

#: Texts with characters from here on go to the tokenizer whole.
LATIN_END = 0x250


def default_vocabulary() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def latin(prefix: str) -> str:
    """Members of a Unicode category below LATIN_END, for a character class."""
    return "".join(re.escape(chr(c)) for c in range(LATIN_END) if unicodedata.category(chr(c)).startswith(prefix))


def pre_token_pattern() -> re.Pattern:
    """The pre-tokens of byte-level BPE: contractions, words, numbers, symbols, white space."""
    letters, numbers, space = latin("L"), latin("N"), "\t-\r \x85\xa0"
    return re.compile(
        f"'(?:[stmd]|re|ve|ll)| ?[{letters}]+| ?[{numbers}]+| ?[^{space}{letters}{numbers}]+|[{space}]+(?![^{space}])|[{space}]+"
    )


class TextTokens:
    """Ids as little-endian unsigned 32-bit numbers in one bytes object per text.

    Names of special tokens in a text are ordinary text, or with ``named`` the ids
    that the plain tokenizer gives for them.
    """

    def __init__(self, path: str, named: bool = False) -> None:
        from tokenizers import Tokenizer

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = not named
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        names = [token["content"] for token in spec.get("added_tokens") or []] if named else []
        self.names = re.compile("|".join(map(re.escape, names))) if names else None
        cut = spec.get("pre_tokenizer") or {}
        by_pre_token = cut.get("type") == "ByteLevel" and cut.get("use_regex", True) and not cut.get("add_prefix_space") and not spec.get("normalizer")
        self.pattern = pre_token_pattern() if by_pre_token else None
        self.beyond = re.compile(f"[^\x00-{chr(LATIN_END - 1)}]")
        self.known: dict[str, bytes] = {}
        self.earlier: dict[str, bytes] = {}

    def encode(self, texts: list[str]) -> list[bytes]:
        return [pack(f"<{len(e)}I", *e.ids) for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def packed(self, text: str) -> bytes:
        if self.pattern is None or self.beyond.search(text) or (self.names and self.names.search(text)):
            return self.encode([text])[0]
        parts = self.pattern.findall(text)
        missing = set(parts).difference(self.known)
        if missing:
            if len(self.known) + len(missing) > REMEMBERED:
                self.earlier, self.known = self.known, {}
                missing = set(parts)
            again = {part: self.earlier[part] for part in missing if part in self.earlier}
            self.known.update(again)
            new = [part for part in missing if part not in again]
            self.known.update(zip(new, self.encode(new), strict=True))
        return b"".join(map(self.known.__getitem__, parts))


@worker_cache
def text_tokens(path: str, named: bool = False) -> TextTokens:
    """One tokenizer per vocabulary file, treatment of names and worker."""
    return TextTokens(path, named)
