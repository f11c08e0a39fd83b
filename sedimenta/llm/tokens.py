"""Token ids of whole texts by the ``tokenizers`` library, each different piece encoded once.

The library splits a text into words and punctuation before it merges bytes, and never merges
across that split. Texts are therefore cut where it is sure to split, and the ids of each piece
are remembered. Where punctuation stands together a text is cut at spaces only, and one with white
space next to each other is encoded as it is.
"""

from __future__ import annotations

import re
from array import array
from collections.abc import Iterator

import numpy as np

# Pieces that are remembered, about 200 bytes each. Of a full memory the older half goes, without
# the pieces that were met since.
REMEMBERED = 500_000

# Characters of texts that are cut at once.
CUT_AT_ONCE = 8_000_000

_RUN_OF_SPACE = re.compile(r"\s\s")
# A comma or dot that comes after something else than a letter or digit, or before another sign.
_RUN_OF_SIGNS = re.compile(r"[.,](?:(?<![^\W_][.,])|(?=[^\w\s]|_))")

_encoders: dict[tuple[str, bool], "Encoder"] = {}


def encoder(path: str, keeps_space: bool) -> "Encoder":
    """The encoder of this process for a vocabulary file; its memory outlives a task."""
    found = _encoders.get((path, keeps_space))
    if found is None:
        found = _encoders[path, keeps_space] = Encoder(path, keeps_space)
    return found


class Encoder:
    """``keeps_space``: whether a space belongs to the word after it or is dropped."""

    def __init__(self, path: str, keeps_space: bool) -> None:
        import os

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(path)
        self.keeps_space = keeps_space
        self.dtype = id_type(self.library.get_vocab_size())
        self.code = {"<u2": "H", "<u4": "I"}[self.dtype]
        self.known: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}

    def _ids(self, texts: list[str]) -> list[bytes]:
        # Where in a text its ids come from is not asked for.
        found = self.library.encode_batch_fast(texts, add_special_tokens=False)
        return [array(self.code, e.ids).tobytes() for e in found]

    def _marked(self, text: str) -> str:
        """The text with a mark wherever it is cut; without any if it is not."""
        if "\0" in text:
            return ""
        if _RUN_OF_SPACE.search(text):
            return text
        if not _RUN_OF_SIGNS.search(text):
            text = text.replace(",", "\0,").replace(".", "\0.")
        if self.keeps_space:
            return text.replace(" ", "\0 ").replace("\n", "\0\n\0")
        return text.replace(" ", "\0").replace("\n", "\0")

    def _remembered(self, pieces: list[str]) -> list[bytes]:
        """The ids of different pieces."""
        found = list(map(self.known.get, pieces))
        places = [i for i, ids in enumerate(found) if ids is None]
        if not places:
            return found
        met = [pieces[i] for i in places]
        earlier = list(map(self.older.get, met))
        new = iter(self._ids([p for p, ids in zip(met, earlier, strict=True) if ids is None]))
        learnt = [next(new) if ids is None else ids for ids in earlier]
        for i, ids in zip(places, learnt, strict=True):
            found[i] = ids
        if len(self.known) + len(met) > REMEMBERED // 2:
            self.older, self.known = self.known, {}
        # More than half a memory at once is not worth remembering.
        self.known.update(zip(met[: REMEMBERED // 2], learnt))
        return found

    def encode(self, texts: list[str]) -> Iterator[bytes]:
        """The ids of each text, as bytes of :attr:`dtype`.

        Arrow cuts the texts, tells which pieces are different, and puts their ids together.
        """
        import pyarrow as pa
        import pyarrow.compute as pc

        start = 0
        while start < len(texts):
            stop, size = start, 0
            while stop < len(texts) and (size == 0 or size + len(texts[stop]) <= CUT_AT_ONCE):
                size += max(1, len(texts[stop]))
                stop += 1
            marked = list(map(self._marked, texts[start:stop]))
            # A text that is left whole is not worth remembering.
            whole = [i for i, m in enumerate(marked) if "\0" not in m]
            alone = dict(zip(whole, self._ids([texts[start + i] for i in whole]), strict=True))
            if len(whole) < len(marked):
                kept = [None if i in alone else m for i, m in enumerate(marked)]
                cut = pc.split_pattern(pa.array(kept, pa.large_string()), "\0")
                pieces = cut.flatten().dictionary_encode()
                found = self._remembered(pieces.dictionary.to_numpy(zero_copy_only=False).tolist())
                joined = pa.array(found, pa.large_binary()).take(pieces.indices)
                places, octets = joined.buffers()[1:]
                ends = np.frombuffer(places, np.int64, len(joined) + 1)[cut.offsets.to_numpy()]
                ids = memoryview(octets or b"")
            for i in range(stop - start):
                yield alone[i] if i in alone else bytes(ids[ends[i] : ends[i + 1]])
            start = stop


def vocabulary(name: str) -> str:
    """Place of a public vocabulary file, which every machine has installed."""
    import public_tokenizers

    return public_tokenizers.path(name)


def id_type(vocabulary: int) -> str:
    """The smallest little-endian type for the ids of a vocabulary."""
    return "<u2" if vocabulary <= 1 << 16 else "<u4"
