"""Byte-level BPE vocabularies, read from a public tokenizer's JSON file."""

from __future__ import annotations

import json
from functools import lru_cache

import public_tokenizers

DEFAULT = public_tokenizers.path("byte_bpe_50k.json")


def _byte_of_character() -> dict[str, int]:
    """Byte-level vocabularies spell printable bytes as themselves and the others from U+0100 on."""
    printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [b for b in range(256) if b not in printable]
    return {chr(b): b for b in printable} | {chr(256 + i): b for i, b in enumerate(others)}


def _splits_as_stated(content: dict) -> bool:
    """Whether text is split by the pattern of byte-level vocabularies, and by nothing else before or after."""
    split = content.get("pre_tokenizer") or {}
    plain = split.get("type") == "ByteLevel" and split.get("use_regex", True) and not split.get("add_prefix_space")
    return plain and not content.get("normalizer") and content["model"].get("type", "BPE") == "BPE"


class Vocabulary:
    """Ids by bytes, merges by pair of bytes, and the strings of special tokens."""

    def __init__(self, path: str):
        with open(path) as file:
            content = json.load(file)
        if not _splits_as_stated(content):
            raise ValueError(f"{path} does not split text as byte-level vocabularies do")
        alphabet = _byte_of_character()

        def spelled(token: str) -> bytes:
            return bytes(alphabet[c] for c in token)

        self.path = path
        self.special = {token["content"]: token["id"] for token in content["added_tokens"]}
        self.ids = {spelled(t): i for t, i in content["model"]["vocab"].items() if t not in self.special}
        merges = (m if isinstance(m, list) else m.split(" ") for m in content["model"]["merges"])
        self.merge_rank = {(spelled(a), spelled(b)): rank for rank, (a, b) in enumerate(merges)}
        self.size = max([*self.ids.values(), *self.special.values()]) + 1


@lru_cache(maxsize=2)
def load(path: str) -> Vocabulary:
    """The vocabulary, kept by a worker between tasks."""
    return Vocabulary(path)
