"""Ids of whole texts by a byte-level BPE file of the tokenizers library.

A file whose merges are numbered in their order says the same as a table of ranks, and texts
of characters that every version of Unicode classes alike are split alike by both libraries. Such texts
go through ``tiktoken``, which is several times faster and remembers nothing; all others, those that
hold a special token and any file of another kind go to the tokenizers library itself.
"""

from __future__ import annotations

import functools
import json
import re

import numpy as np
import tiktoken
from tokenizers import Tokenizer

#: Fixed value: how byte-level files of this kind split text.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
#: Anything but tabs, line breaks, printable ASCII and Latin letters and signs.
UNCOMMON = re.compile("[^\t\n\r -~¡-ɏ]")


def byte_letters() -> dict[str, int]:
    """The letter that stands for each byte in the file: printable ones themselves, the rest from 256 on."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


def ranks(path: str) -> dict[bytes, int] | None:
    """The file as a table of ranks, or None if it says more than such a table can."""
    with open(path, encoding="utf-8") as file:
        data = json.load(file)
    model, split = data["model"], data["pre_tokenizer"] or {}
    usual = (
        model["type"] == "BPE" and data["normalizer"] is None
        and split.get("type") == "ByteLevel" and not split["add_prefix_space"] and split.get("use_regex", True)
        and not any(model.get(k) for k in ("dropout", "unk_token", "continuing_subword_prefix", "end_of_word_suffix", "byte_fallback", "ignore_merges"))
        and all(t["normalized"] is False and not (t["lstrip"] or t["rstrip"] or t["single_word"]) for t in data["added_tokens"])
    )
    if not usual:
        return None
    vocab = model["vocab"]
    merged = [vocab["".join(m) if isinstance(m, list) else m.replace(" ", "", 1)] for m in model["merges"]]
    letters = byte_letters()
    special = {t["content"] for t in data["added_tokens"]}
    table = {bytes(letters[c] for c in token): i for token, i in vocab.items() if token not in special}
    first = len(table) - len(merged)
    if first != 256 or merged != list(range(256, 256 + len(merged))) or any(len(t) > 1 and i < 256 for t, i in table.items()):
        return None
    return table


class Encoder:
    """The library's ids of whole texts, without special tokens of its own, truncation or padding."""

    def __init__(self, path: str) -> None:
        self.library = Tokenizer.from_file(path)
        self.library.no_truncation()
        self.library.no_padding()
        self.kind = np.dtype("<u2" if self.library.get_vocab_size() <= 1 << 16 else "<u4")
        self.special = [t.content for t in self.library.get_added_tokens_decoder().values()]
        table = ranks(path)
        self.fast = table and tiktoken.Encoding("file", pat_str=PATTERN, mergeable_ranks=table, special_tokens={})

    def whole(self, text: str) -> np.ndarray:
        return np.array(self.library.encode_batch_fast([text], add_special_tokens=False)[0].ids, dtype=self.kind)

    def ids(self, text: str) -> np.ndarray:
        if self.fast and not UNCOMMON.search(text) and not any(s in text for s in self.special):
            try:
                return self.fast.encode_to_numpy(text, disallowed_special=()).astype(self.kind)
            except ValueError:  # white space too long for its pattern matcher
                pass
        return self.whole(text)

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        return [self.ids(text) for text in texts]


@functools.cache
def encoder(path: str) -> Encoder:
    """One encoder for a Python worker."""
    return Encoder(path)
