"""Token ids of whole texts by a public tokenizer file, inside tasks.

Ids are those of the ``tokenizers`` library. Where the file is a plain byte-level BPE whose
merges are numbered in order, ``tiktoken`` computes the same ids several times faster; texts
with a character on which the two libraries' character classes might differ, or with the
string of an added token, still go through ``tokenizers``.
"""

from __future__ import annotations

import functools
import json
import os
import re

import numpy as np

# Fixed value: how byte-level BPE cuts a text into words.
_WORD = (
    r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
)
# Latin letters, marks and digits and common punctuation: both libraries class these alike.
_PLAIN = re.compile(r"[\t\n\r -~¡-¬®-ſ‐-‧€]*\Z")


def _byte_of() -> dict[str, int]:
    """The printable stand-in of every byte in byte-level vocabularies."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in shown]
    return {chr(b): b for b in shown} | {chr(256 + k): b for k, b in enumerate(rest)}


class Encoder:
    def __init__(self, path: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.exact = Tokenizer.from_file(path)
        self.fast, self.added = None, []
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        model, cut = spec["model"], spec.get("pre_tokenizer") or {}
        ordinary = (
            model.get("type") == "BPE"
            and not spec.get("normalizer")
            and cut.get("type") == "ByteLevel"
            and not cut.get("add_prefix_space")
            and cut.get("use_regex", True)
            and not any(model.get(k) for k in ("dropout", "ignore_merges", "byte_fallback"))
            and not any(model.get(k) for k in ("continuing_subword_prefix", "end_of_word_suffix"))
        )
        if ordinary:
            self.added = [t["content"] for t in spec.get("added_tokens", [])]
            byte, vocab = _byte_of(), model["vocab"]
            ranks = {
                bytes(byte[c] for c in word): i for word, i in vocab.items() if word not in self.added
            }
            merges = [m if isinstance(m, list) else m.split(" ") for m in model["merges"]]
            if [vocab[a + b] for a, b in merges] == list(range(256, 256 + len(merges))):
                import tiktoken

                self.fast = tiktoken.Encoding(
                    "plain", pat_str=_WORD, mergeable_ranks=ranks, special_tokens={}
                )

    def __call__(self, text: str | None) -> np.ndarray:
        """uint32 ids; none for a null or empty text."""
        if not text:
            return np.zeros(0, np.uint32)
        if self.fast and _PLAIN.match(text) and not any(a in text for a in self.added):
            return np.array(self.fast.encode_ordinary(text), np.uint32)
        return np.array(self.exact.encode(text, add_special_tokens=False).ids, np.uint32)


@functools.lru_cache(maxsize=2)
def encoder(path: str) -> Encoder:
    """The encoder of a tokenizer file, loaded once in each Python worker."""
    return Encoder(path)


def cuts(total: int, limit: int) -> list[tuple[int, int]]:
    """(start, length) of the pieces of ``total`` ids: full ones, the first may be shorter."""
    first = total % limit or min(total, limit)
    return [(0, first), *((s, limit) for s in range(first, total, limit))] if total else []
