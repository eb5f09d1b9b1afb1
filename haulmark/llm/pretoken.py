"""Splitting text as a byte-level BPE tokenizer file does before its merges.

Tokens never reach over the pieces made here, so pieces can be encoded one by one,
and equal pieces once.
"""

from __future__ import annotations

import functools
import json
import re
import sys
import unicodedata

import regex

# The split pattern of byte-level BPE files.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""

_SPLIT = regex.compile(PATTERN)
#: Up to this code point (Latin, Greek, Cyrillic) all libraries agree on what is a letter, digit or white space.
_AGREED = 0x52F


def _classes() -> tuple[str, str, str]:
    """Character sets up to ``_AGREED`` for letters, numbers and white space."""
    sets = {"L": "", "N": "", "white": "\\t-\\r"}
    for c in map(chr, range(0x20, _AGREED + 1)):
        kind = "white" if c in " \x85\xa0" else unicodedata.category(c)[0]
        if kind in sets:
            sets[kind] += c
    return sets["L"], sets["N"], sets["white"]


_L, _N, _S = _classes()
#: The same pattern with plain sets, for the standard library, which is faster.
_NEAR = re.compile(f"'s|'t|'re|'ve|'m|'ll|'d| ?[{_L}]+| ?[{_N}]+| ?[^{_S}{_L}{_N}]+|[{_S}]+(?![^{_S}])|[{_S}]+")
_FAR = re.compile(f"[^\0-{chr(_AGREED)}]")


@functools.cache
def _unassigned() -> regex.Pattern:
    """Code points that have no meaning yet in some version of Unicode; libraries differ on them."""
    ranges, start = [], None
    for c in range(0x530, sys.maxunicode + 2):
        odd = c <= sys.maxunicode and unicodedata.category(chr(c)) == "Cn"
        if odd and start is None:
            start = c
        elif not odd and start is not None:
            ranges.append(f"\\U{start:08x}-\\U{c - 1:08x}")
            start = None
    return re.compile("[" + "".join(ranges) + "]")


def byte_letters() -> dict[str, int]:
    """The letter that stands for each byte in byte-level files: itself if printable, else one from U+0100 on."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = [b for b in range(256) if b not in set(shown)]
    return {chr(b): b for b in shown} | {chr(0x100 + k): b for k, b in enumerate(hidden)}


class Splitter:
    """Pieces of texts for a tokenizer file of that kind; ``fits`` says whether a file is."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        before = spec.get("pre_tokenizer") or {}
        added = spec.get("added_tokens") or []
        self.fits = (spec["model"].get("type") == "BPE" and not spec.get("normalizer") and not spec.get("post_processor")
                     and before.get("type") == "ByteLevel" and not before.get("add_prefix_space") and before.get("use_regex", True)
                     and not any(a["lstrip"] or a["rstrip"] or a["single_word"] for a in added))
        self.special = {a["content"]: a["id"] for a in added}
        self.model = spec["model"]
        words = sorted(self.special, key=len, reverse=True)
        self._special = re.compile("(" + "|".join(map(re.escape, words)) + ")") if words else None
        self._path = path

    @functools.cached_property
    def _library(self):
        from tokenizers import Tokenizer
        return Tokenizer.from_file(self._path).pre_tokenizer

    def _plain(self, text: str) -> list[str]:
        if text.isascii() or not _FAR.search(text):
            return _NEAR.findall(text)
        if _unassigned().search(text):
            return [text[a:b] for _, (a, b) in self._library.pre_tokenize_str(text)]
        return _SPLIT.findall(text)

    def pieces(self, text: str) -> list[str]:
        if self._special is None or not self._special.search(text):
            return self._plain(text)
        out: list[str] = []
        for k, part in enumerate(self._special.split(text)):
            if k % 2:
                out.append(part)
            elif part:
                out += self._plain(part)
        return out
