"""Texts as sequences of reusable segments of pre-tokens.

The byte-level tokenizer pattern opens a new piece at a single space, and
makes a single line feed a piece of its own, when both neighbours are visible
characters.  A text with no other white space is therefore cut there, and each
distinct segment is split by the pattern once.  A text with runs of white
space is cut only at its single spaces, which keeps the runs whole.

A segment is written as a key: the first of a text after a tab, one that
follows a line feed with that line feed, any other without its leading space.
"""

from __future__ import annotations

import re

_SAFE = re.compile(r"(?<=\S) (?=\S)")
#: Latin letters, then marks that are neither letters, digits nor quotes.
_PLAIN = re.compile(r"([\t\n]?)([A-Za-zÀ-ÖØ-öø-ɏ]+)([.,;:!?#$%&*()|]*)\Z")


def segments(text: str) -> list[str]:
    """The keys of the text's segments, in order; empty for an empty text."""
    if not text:
        return []
    flat = text.replace("\n", " ").split(" ")
    if "" in flat or list(map(str.strip, flat)) != flat:
        keys = _SAFE.split(text)
    else:
        keys = text.replace("\n", " \n").split(" ")
    keys[0] = "\t" + keys[0]
    return keys


def segment_text(key: str) -> str:
    lead = key[0]
    return key[1:] if lead == "\t" else key if lead == "\n" else " " + key


class Splitter:
    """Pieces of a segment under the pattern, by the Unicode tables of the
    tokenizers library (which are those of tiktoken, too; the ``regex`` package
    has newer ones and would split unassigned letters differently)."""

    def __init__(self, pattern: str):
        from tokenizers import Regex, pre_tokenizers

        self._split = pre_tokenizers.Split(Regex(pattern), "isolated").pre_tokenize_str

    def pieces(self, key: str) -> list[str]:
        plain = _PLAIN.match(key)
        if plain is None:
            return [piece for piece, _ in self._split(segment_text(key))]
        lead, word, marks = plain.groups()
        out = ["\n", word] if lead == "\n" else [word if lead else " " + word]
        if marks:
            out.append(marks)
        return out
