"""Token ids of texts as packed bytes, from a ``tokenizers`` JSON file."""

from __future__ import annotations

import json
import os
import re

import numpy as np

DEFAULT = "byte_bpe_50k.json"

# Fixed value: how a byte-level pre-tokenizer splits text.
BYTE_LEVEL = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"


def default_tokenizer() -> str:
    """Path of the public tokenizer file, on whatever machine this runs."""
    import public_tokenizers

    return public_tokenizers.path(DEFAULT)


def _byte_letters() -> dict[str, int]:
    """The letter a byte-level vocabulary writes for each byte: itself if printable, else one from 256 on."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    letters = {chr(b): b for b in shown}
    hidden = [b for b in range(256) if b not in set(shown)]
    return letters | {chr(256 + i): b for i, b in enumerate(hidden)}


def _byte_ranks(spec: dict) -> dict[bytes, int] | None:
    """Bytes -> id of a plain byte-level BPE whose merges apply in order of id; None for any other model."""
    model, pre = spec["model"], spec.get("pre_tokenizer") or {}
    plain = (
        model.get("type") == "BPE" and pre.get("type") == "ByteLevel" and pre.get("use_regex", True)
        and not (pre.get("add_prefix_space") or spec.get("normalizer") or spec.get("truncation") or model.get("dropout"))
        and not (model.get("continuing_subword_prefix") or model.get("end_of_word_suffix") or model.get("ignore_merges"))
    )
    if not plain:
        return None
    vocab, letters = model["vocab"], _byte_letters()
    pairs = [m.split(" ") if isinstance(m, str) else m for m in model["merges"]]
    order = [vocab["".join(p)] for p in pairs]
    if order != sorted(order) or not all(c in vocab for c in letters):
        return None
    tokens = [*letters, *("".join(p) for p in pairs)]
    if max(vocab[c] for c in letters) >= min(order, default=len(vocab)):
        return None
    return {bytes(letters[c] for c in t): vocab[t] for t in tokens}


class Encoder:
    """Little-endian unsigned ids of a text, without special tokens added.

    A plain byte-level BPE runs in a faster implementation of the same merges;
    every other model, and texts that hold an added token's string, in the
    tokenizer itself. Both give the same ids.
    """

    def __init__(self, path: str | None = None, dtype: str = "<u4"):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        import tiktoken
        from tokenizers import Tokenizer

        with open(path or default_tokenizer(), encoding="utf-8") as file:
            text = file.read()
        self._tokenizer, spec = Tokenizer.from_str(text), json.loads(text)
        if self._tokenizer.get_vocab_size() > np.iinfo(np.dtype(dtype)).max + 1:
            raise ValueError(f"{dtype} is too narrow for the vocabulary")
        added = [t["content"] for t in spec.get("added_tokens", [])]
        self._added = re.compile("|".join(map(re.escape, added))) if added else None
        self._dtype, ranks = np.dtype(dtype), _byte_ranks(spec)
        self._fast = ranks and tiktoken.Encoding(
            "bytes", pat_str=BYTE_LEVEL, mergeable_ranks=ranks, special_tokens={}
        ).encode_ordinary

    def encode(self, text: str) -> bytes:
        if self._fast and not (self._added and self._added.search(text)):
            ids = self._fast(text)
        else:
            ids = self._tokenizer.encode(text, add_special_tokens=False).ids
        return np.array(ids, self._dtype).tobytes()


_ENCODERS: dict[tuple, Encoder] = {}


def encoder(path: str | None, dtype: str = "<u4") -> Encoder:
    """One encoder per worker process."""
    key = (path, dtype)
    if key not in _ENCODERS:
        _ENCODERS[key] = Encoder(path, dtype)
    return _ENCODERS[key]
