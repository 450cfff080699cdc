"""Byte-level BPE ids of whole texts from a public tokenizer file.

The vocabulary file is named by a parameter and found on each executor; it is
never shipped or trained. Ids equal those of the ``tokenizers`` library with
``add_special_tokens=False`` in its default state: where a text holds the string of an
added token, that token stands for it.
"""

from __future__ import annotations

import json
import os
import re

import numpy as np

#: Fixed value: the pre-tokenising pattern of byte-level BPE vocabularies of this family.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
#: Chunks remembered per Python worker (about 100 bytes each).
CACHE_CHUNKS = 400_000


def vocabulary_path(name: str) -> str:
    """An existing path, or the place of a file of the installed public tokenizers."""
    if os.path.exists(name):
        return name
    import public_tokenizers

    return public_tokenizers.path(name)


def _vocabulary(path: str) -> tuple[dict[bytes, int], dict[str, int]]:
    """(token bytes -> id, string of an added token -> id). In this format ids follow the merge order."""
    with open(path, encoding="utf-8") as f:
        spec = json.load(f)
    added = spec.get("added_tokens", ())
    if any(t.get(k) for t in added for k in ("lstrip", "rstrip", "single_word", "normalized")):
        raise ValueError(f"{path}: only plain added tokens are supported")
    special = {t["content"]: t["id"] for t in added}
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    shown = {chr(b): b for b in plain}
    shown |= {chr(256 + k): b for k, b in enumerate(b for b in range(256) if b not in set(plain))}
    tokens = {bytes(shown[c] for c in token): i for token, i in spec["model"]["vocab"].items() if token not in special}
    return tokens, special


class _Chunks(dict):
    """Chunk between single spaces -> packed ids of the chunk with its leading space.

    A pre-token holds a space only as its first character, so cutting before a
    lone space between two non-space characters never cuts a pre-token. Chunks
    that are empty or begin or end in white space have no entry (None): their
    text is encoded as a whole.
    """

    def __init__(self, encode):
        super().__init__()
        self._encode = encode

    def __missing__(self, chunk: str) -> bytes | None:
        if not chunk or chunk[0].isspace() or chunk[-1].isspace():
            ids = None
        else:
            ids = np.array(self._encode(" " + chunk), "<u4").tobytes()
        if len(self) < CACHE_CHUNKS:
            self[chunk] = ids
        return ids


class Encoder:
    """encode(text) -> ids as packed little-endian unsigned 32-bit numbers."""

    def __init__(self, name: str):
        import tiktoken

        ranks, added = _vocabulary(vocabulary_path(name))
        self.size = 1 + max([*ranks.values(), *added.values()])
        self._added = {s: i.to_bytes(4, "little") for s, i in added.items()}
        longest_first = sorted(map(re.escape, added), key=len, reverse=True)
        self._cut = re.compile(f"({'|'.join(longest_first)})") if added else None
        self._whole = tiktoken.Encoding("llm-pack", pat_str=PATTERN, mergeable_ranks=ranks,
                                        special_tokens={}).encode_ordinary
        self._chunks = _Chunks(self._whole)

    def encode(self, text: str) -> bytes:
        if any(s in text for s in self._added):
            return b"".join(self._added.get(x) or self._plain(x) for x in self._cut.split(text))
        return self._plain(text)

    def _plain(self, text: str) -> bytes:
        first, *rest = text.split(" ")
        if first and not first[-1].isspace():
            try:
                head = np.array(self._whole(first), "<u4").tobytes()
                return head + b"".join(map(self._chunks.__getitem__, rest))
            except TypeError:  # a chunk without an entry
                pass
        return np.array(self._whole(text), "<u4").tobytes()
