"""Byte-level BPE vocabularies inside tasks: file, alphabet, library-speed encoding, and grouping of rows by text size."""

from __future__ import annotations

import json
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Fixed value: the published word pattern of this byte-level tokenizer family.
WORD_PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
#: Rows are handled in groups of about so many bytes of text.
GROUP_BYTES = 2_000_000


def default_path() -> str:
    """The public byte-level vocabulary that the queries use."""
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def byte_of_symbol() -> dict[str, int]:
    """The printable stand-in of every byte: itself where printable, else the next free code point from 256 on."""
    plain = {*range(33, 127), *range(161, 173), *range(174, 256)}
    rest = (b for b in range(256) if b not in plain)
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


class Vocabulary:
    """Tokens as bytes by id, merges as (left id, right id, new id) in rank order, and added tokens."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            stored = json.load(f)
        model, byte = stored["model"], byte_of_symbol()
        ids: dict[str, int] = model["vocab"]
        self.special: dict[str, int] = {t["content"]: t["id"] for t in stored["added_tokens"]}
        self.bytes: list[bytes] = [b""] * (1 + max([*ids.values(), *self.special.values()]))
        for token, i in ids.items():
            self.bytes[i] = bytes(byte[c] for c in token) if all(c in byte for c in token) else token.encode()
        for token, i in self.special.items():
            self.bytes[i] = token.encode()
        pairs = (m.split(" ", 1) if isinstance(m, str) else m for m in model["merges"])
        self.merges = [(ids[a], ids[b], ids[a + b]) for a, b in pairs]
        self.of_byte = [ids[s] for s, _ in sorted(byte.items(), key=lambda x: x[1])]


@lru_cache(maxsize=2)
def vocabulary(path: str) -> Vocabulary:
    return Vocabulary(path)


@lru_cache(maxsize=2)
def fast_encoder(path: str):
    """text -> ids (unsigned 32-bit array) as the tokenizers library gives them, by the compiled encoder of ``tiktoken``.

    That encoder ranks merges by id, so it serves vocabularies whose ids rise with the merge order; for any other the
    tokenizers library itself is used.
    """
    vocab = vocabulary(path)
    new = [n for _, _, n in vocab.merges]
    if all(a < b for a, b in zip(new, new[1:])) and max(vocab.of_byte) < min(new, default=1 << 30):
        import tiktoken

        plain = {vocab.bytes[i]: i for i in [*vocab.of_byte, *new]}
        compiled = tiktoken.Encoding("file", pat_str=WORD_PATTERN, mergeable_ranks=plain, special_tokens=vocab.special)
        return lambda text: compiled.encode_to_numpy(text, allowed_special="all", disallowed_special=())
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(path)
    tokenizer.no_truncation()
    tokenizer.no_padding()
    return lambda text: np.array(tokenizer.encode(text, add_special_tokens=False).ids, np.uint32)


def text_groups(batches: Iterator[pa.RecordBatch], text: str = "text") -> Iterator[pa.Table]:
    """Rows in groups of about ``GROUP_BYTES`` of text (a longer text is a group of its own); null texts become empty."""
    for batch in batches:
        if batch.num_rows == 0:
            continue
        table = pa.Table.from_batches([batch])
        at = table.schema.get_field_index(text)
        table = table.set_column(at, text, pc.fill_null(table.column(at), ""))
        sizes = np.cumsum(pc.binary_length(table.column(at)).to_numpy())
        start = 0
        while start < table.num_rows:
            base = sizes[start - 1] if start else 0
            end = max(start + 1, int(np.searchsorted(sizes, base + GROUP_BYTES, "right")))
            yield table.slice(start, end - start)
            start = end
        del table, batch
        pa.default_memory_pool().release_unused()  # a worker serves many stages; what a batch took goes back
