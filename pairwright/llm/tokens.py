"""Token ids by a public byte-level BPE vocabulary."""

from __future__ import annotations

import json
import re
from array import array
from collections.abc import Iterable, Iterator
from functools import cached_property, lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import tiktoken
from tokenizers import Tokenizer

# Fixed value: how byte-level BPE of this kind cuts text before merging.
WORDS = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+"""
PIECES = WORDS + r"|\s+(?!\S)|\s+"
# The same pieces where ``long_run`` finds nothing; without looking ahead they are found faster.
SHORT_RUNS = WORDS + r"|\s"
# Letters and white space here are the same in every Unicode version in use.
SETTLED = re.compile("[^\u0000-\u052f\u2000-\u206f]")


def unsettled(text: str) -> bool:
    return not text.isascii() and SETTLED.search(text) is not None

LONG_RUN = re.compile(r"\s\s(?:\s|\Z)")
OTHER_SPACE = [c for c in map(chr, range(0x3001)) if c.isspace() and c not in " \n"]
TWO_SPACES = ("  ", " \n", "\n ", "\n\n")
THREE_SPACES = tuple(two + one for two in TWO_SPACES for one in " \n")
# Characters of texts whose words are gathered at once; longer texts are encoded by themselves.
GATHERED, LONG_TEXT = 8 << 20, 1 << 20


def long_run(text: str) -> bool:
    """Whether three characters of white space stand together, or two at the end."""
    if not any(c in text for c in OTHER_SPACE):
        return text.endswith(TWO_SPACES) or any(s in text for s in THREE_SPACES)
    return LONG_RUN.search(text) is not None


def byte_of_symbol() -> dict[str, int]:
    """Byte-level vocabularies write bytes that print as themselves, others from U+0100 on."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = [b for b in range(256) if b not in set(shown)]
    return {chr(b): b for b in shown} | {chr(0x100 + i): b for i, b in enumerate(hidden)}


def by_rank(model: dict) -> bool:
    """Whether smaller ids of merged tokens mean earlier merges, which ranks stand for."""
    made = [m if isinstance(m, str) else "".join(m) for m in model.get("merges", [])]
    ids = [model["vocab"].get(m.replace(" ", "", 1)) for m in made]
    return None not in ids and all(a < b for a, b in zip(ids, ids[1:]))


class Encoder:
    """The ids ``Tokenizer.from_file(path).encode(text, add_special_tokens=False)`` gives.

    Where the vocabulary is plain byte-level BPE and the text has only settled
    characters and no special token's string, the same merges run several times
    faster in another library; all other texts go to the tokenizer itself.
    """

    def __init__(self, path: str):
        self.path = path
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        self.special = [t["content"] for t in spec.get("added_tokens", [])]
        before = spec.get("pre_tokenizer") or {}
        self.ranks = None
        if (
            spec["model"].get("type") == "BPE" and spec.get("normalizer") is None
            and before.get("type") == "ByteLevel" and before.get("use_regex", True)
            and not before.get("add_prefix_space") and not spec["model"].get("ignore_merges")
            and by_rank(spec["model"])
        ):
            symbols = byte_of_symbol()
            ranks = {
                bytes(symbols[c] for c in token): i
                for token, i in spec["model"]["vocab"].items() if token not in self.special
            }
            self.ranks = ranks
        if self.ranks is None:
            self.size = self.full.get_vocab_size()
        else:
            self.size = len({*spec["model"]["vocab"], *self.special})

    @cached_property
    def full(self) -> Tokenizer:
        full = Tokenizer.from_file(self.path)
        full.no_padding()
        full.no_truncation()
        return full

    def _encoding(self, pieces: str) -> tiktoken.Encoding:
        return tiktoken.Encoding("bytes", pat_str=pieces, mergeable_ranks=self.ranks, special_tokens={})

    @cached_property
    def fast(self) -> tiktoken.Encoding:
        return self._encoding(PIECES)

    @cached_property
    def faster(self) -> tiktoken.Encoding:
        return self._encoding(SHORT_RUNS)

    def quick(self, text: str) -> np.ndarray:
        """Ids of a settled text by the faster library; an array takes over a list faster than numpy."""
        encoding = self.fast if long_run(text) else self.faster
        return np.frombuffer(array("I", encoding.encode_ordinary(text)), np.uint32)

    def encode_plain(self, text: str) -> np.ndarray:
        """Ids of the text alone: strings of special tokens in it are plain text."""
        if self.ranks is None or unsettled(text):
            self.full.encode_special_tokens = True
            ids = self.full.encode(text, add_special_tokens=False).ids
            self.full.encode_special_tokens = False
            return np.array(ids, np.uint32)
        return self.quick(text)

    @cached_property
    def spaced(self) -> np.ndarray:
        """Whether an id's bytes begin with a space."""
        found = np.zeros(max(self.ranks.values()) + 1, bool)
        found[[i for token, i in self.ranks.items() if token[:1] == b" "]] = True
        return found

    def by_words(self, texts: list[str]) -> Iterator[np.ndarray]:
        """Ids of settled texts without a long run; a word that they share is encoded once.

        Without looking ahead each space begins a piece, so the ids of a text are those
        of its parts in front of spaces. The parts of all texts are encoded as one text.
        """
        lists = pc.split_pattern(pa.array(texts, pa.string()), " ")
        edges = lists.offsets.to_numpy()
        coded = lists.flatten().dictionary_encode()
        words, code = coded.dictionary, coded.indices.to_numpy().copy()
        del lists, coded  # each of these is as long as the texts
        # a text's first part has no space in front of it
        code[edges[:-1]] = len(words) + np.arange(len(texts))
        heads = [self.faster.encode_ordinary(text.split(" ", 1)[0]) for text in texts]
        joined = pc.binary_join(pa.ListArray.from_arrays(pa.array([0, len(words)], pa.int32()), words), " ")
        ids = array("I", self.faster.encode_ordinary(" " + joined[0].as_py()))
        starts = np.flatnonzero(self.spaced[np.frombuffer(ids, np.uint32)])
        sizes = np.append(np.diff(starts, append=len(ids)), [len(h) for h in heads])
        starts = np.append(starts, len(ids) + np.cumsum(sizes[len(words) :]) - sizes[len(words) :])
        for head in heads:
            ids.extend(head)
        ids = np.frombuffer(ids, np.uint32)
        for i, j in zip(edges[:-1].tolist(), edges[1:].tolist()):
            part = code[i:j]
            size = sizes[part]
            end = np.cumsum(size)
            yield ids[np.repeat(starts[part] - end + size, size) + np.arange(end[-1])]

    def encode_all(self, texts: Iterable[str]) -> Iterator[np.ndarray]:
        """``encode`` of each text, in their order."""
        held, chars = [], 0
        for text in texts:
            held.append(text)
            chars += len(text)
            if chars >= GATHERED:
                yield from self._encode_held(held)
                held, chars = [], 0
        yield from self._encode_held(held)

    def _encode_held(self, texts: list[str]) -> Iterator[np.ndarray]:
        short = [
            self.ranks is not None and len(t) < LONG_TEXT and not unsettled(t)
            and not any(s in t for s in self.special) and not long_run(t) for t in texts
        ]
        found = self.by_words([t for t, s in zip(texts, short) if s])
        for text, is_short in zip(texts, short):
            yield next(found) if is_short else self.encode(text)

    def encode(self, text: str) -> np.ndarray:
        if self.ranks is None or unsettled(text) or any(s in text for s in self.special):
            return np.array(self.full.encode(text, add_special_tokens=False).ids, np.uint32)
        return self.quick(text)


@lru_cache(maxsize=4)
def encoder_of(path: str) -> Encoder:
    """The encoder of a file, made once for each Python worker and not for each task."""
    return Encoder(path)
