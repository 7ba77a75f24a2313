"""Cutting text at places where a byte-level BPE tokenizer always cuts.

The tokenizer's own pattern never lets a token cross from a non-white
character into a following white one, and a single space or line feed between
two non-white characters always starts a new pre-token.  So does ASCII punctuation
(but the apostrophe) after a letter.  Cutting there gives pre-tokens (" word",
"\nword", ".") whose encodings, put one after another, are the encoding of the
whole text.  A pre-token is encoded once, when a process meets it first: by the
``tokenizers`` library, or, where all its characters are ASCII or Latin-1
letters (whose classes no Unicode version moves), by ``tiktoken`` with the
vocabulary and merges of the same file, which gives the same ids in a third of
the time.  That needs the file's merges to be in the order of their ids, which
is checked when it is read; otherwise ``tokenizers`` encodes all."""

from __future__ import annotations

import re
import struct

SPECIAL_WHITE = re.compile("[\t\r\x0b\x0c\x1c-\x1f\x85\xa0  -     　]")
SAFE = re.compile(r"(?<=\S)(?=[ \n]\S)")
MARK = ""  # a private-use character; texts that hold it take the slower cut

PUNCT = "!\"#$%&()*+,-./:;<=>?@[\\]^_`{|}~"
LETTER = re.compile("[A-Za-zÀ-ÖØ-öø-ɏ]")
SPECIAL = "<|"  # special strings of the public vocabularies begin so

FAST = re.compile("[\t\n -~À-ÖØ-öø-ÿ]*")

_TOKENIZERS: dict[str, object] = {}
_FAST: dict[str, object] = {}
_IDS: dict[str, Ids] = {}
MAX_CACHE = 800_000
#: Characters of a chunk whose ids are kept, bytes of all that are kept in a
#: process, and what an entry takes besides its characters and ids.
KEPT_CHARS, KEPT_BYTES, ENTRY_BYTES = 64, 160 << 20, 220


def default_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def tokenizer(path: str):
    """The tokenizer of ``path``, once per process, without padding or truncation."""
    if path not in _TOKENIZERS:
        import os

        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        t = Tokenizer.from_file(path)
        t.no_padding()
        t.no_truncation()
        _TOKENIZERS[path] = t
    return _TOKENIZERS[path]


def cut(text: str) -> list[str]:
    """Chunks of ``text`` in order; joined they are the text."""
    if ("  " in text or "\n\n" in text or " \n" in text or "\n " in text
            or MARK in text or SPECIAL_WHITE.search(text)):
        return SAFE.split(text)
    return text.replace(" ", MARK + " ").replace("\n", MARK + "\n").split(MARK)


def byte_names() -> dict[str, int]:
    """Characters that stand for bytes in a byte-level vocabulary: printable
    ones for themselves, the rest follow from 256 on."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in shown]
    return {chr(b): b for b in shown} | {chr(256 + k): b for k, b in enumerate(rest)}


def same_vocabulary(path: str):
    """A tiktoken encoding with the vocabulary of a byte-level .json file, or
    None if its merges are not in the order of their ids."""
    if path not in _FAST:
        import json

        import public_tokenizers
        import tiktoken

        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model, pre = spec["model"], spec.get("pre_tokenizer") or {}
        names, vocab = byte_names(), model.get("vocab", {})
        merges = [m.split(" ") if isinstance(m, str) else m for m in model.get("merges", ())]
        plain = (model.get("type") == "BPE" and not spec.get("normalizer") and pre.get("type") == "ByteLevel"
                 and pre.get("use_regex") and not pre.get("add_prefix_space")
                 and sorted(vocab.get(n, -1) for n in names) == list(range(256))
                 and all(vocab.get(a + b) == 256 + i for i, (a, b) in enumerate(merges)))
        _FAST[path] = tiktoken.Encoding("same", pat_str=public_tokenizers.PATTERN, special_tokens={}, mergeable_ranks={
            bytes(names[c] for c in t): i for t, i in vocab.items() if i < 256 + len(merges)}) if plain else None
    return _FAST[path]


def encode_all(path: str, chunks: list[str], plain: bool = False) -> list[list[int]]:
    """Ids of each chunk; ``plain`` leaves all to ``tokenizers`` and saves the
    memory of the second encoder."""
    fast, t = None if plain else same_vocabulary(path), tokenizer(path)
    out: list[list[int] | None] = [
        fast.encode_ordinary(c) if fast and SPECIAL not in c and FAST.fullmatch(c) else None for c in chunks]
    slow = [i for i, ids in enumerate(out) if ids is None]
    for k in range(0, len(slow), 4096):
        part = slow[k:k + 4096]
        for i, e in zip(part, t.encode_batch_fast([chunks[i] for i in part], add_special_tokens=False)):
            out[i] = e.ids
    return out


def parts(chunk: str) -> tuple[str, ...]:
    """The pre-tokens of a chunk: its trailing punctuation, after a letter,
    stands alone."""
    core = chunk.rstrip(PUNCT)
    if len(core) < len(chunk) and LETTER.match(core[-1:]) and SPECIAL not in chunk:
        return core, chunk[len(core):]
    return (chunk,)


class Ids(dict):
    """Ids of chunks as little-endian unsigned 32-bit numbers.  A chunk that is
    not there is encoded when it is asked for, and kept if it is short: what is
    kept is bounded by its bytes, and text without spaces is one long chunk a
    line that never comes again."""

    def __init__(self, path: str):
        self.fast, self.slow, self.held = same_vocabulary(path), tokenizer(path), 0

    def __missing__(self, chunk: str) -> bytes:
        cut_up = parts(chunk)
        if len(cut_up) > 1:
            ids = self[cut_up[0]] + self[cut_up[1]]
        else:
            if self.fast and SPECIAL not in chunk and FAST.fullmatch(chunk):
                found = self.fast.encode_ordinary(chunk)
            else:
                found = self.slow.encode(chunk, add_special_tokens=False).ids
            ids = struct.pack(f"<{len(found)}I", *found)
        if len(chunk) <= KEPT_CHARS:
            self[chunk] = ids
            self.held += ENTRY_BYTES + len(chunk) + len(ids)
        return ids

    def of(self, text: str) -> bytes:
        if self.held > KEPT_BYTES:
            self.clear()
            self.held = 0
        return b"".join(map(self.__getitem__, cut(text)))


def ids_of(path: str, texts: list[str]) -> list[bytes]:
    """Ids of each text as little-endian unsigned 32-bit numbers."""
    if path not in _IDS:
        _IDS[path] = Ids(path)
    return list(map(_IDS[path].of, texts))


def slices(batch, n_bytes: int = 4 << 20):
    """Row ranges of an Arrow batch that hold about ``n_bytes`` each, so that
    Python never holds more than that of decoded text at once."""
    rows = batch.num_rows
    if not rows:
        return
    step = max(1, int(rows * n_bytes // max(1, batch.nbytes)))
    for k in range(0, rows, step):
        yield batch.slice(k, min(step, rows - k))
