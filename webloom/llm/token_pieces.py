"""Encoding texts with a public tokenizer, word by word.

Both tokenizers cut a text into pre-tokens before they merge, and no pre-token runs on from a non-space to a
space. So a text may be cut before its spaces and the words encoded one by one, with the same ids. Words
repeat: Arrow finds the distinct words of some texts, each worker process remembers the ids of the words it has met,
and encodes new ones many at a time, parted by a separator that keeps a token of its own. Texts with unusual white
space are encoded whole. Where a tokenizer lower-cases and cuts letters from signs (told by its file), words are looked
up in lower case and without the signs behind them, so that fewer are new.
"""

from __future__ import annotations

import json
import os
import sys
import types
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: White space and separators where libraries may differ on what is a space (fixed values).
UNSURE = "\t\r\x0b\x0c\x1c\x1d\x1e\x1f\x85\xa0 ᠎           ​    ⁠　﻿"
#: Words remembered per process; beyond it those met once are forgotten, and of the others all but the most used half.
REMEMBERED = 400_000
#: Characters of a word above which a text is encoded whole.
LONG_WORD = 200
#: Characters of text looked up together, and new words that make one text for the library.
TOGETHER, JOINED = 1 << 22, 200
#: Steps of a tokenizer file that lower-cases and cuts wherever a letter is followed by a sign (fixed values).
LOWERED = [{"type": "NFC"}, {"type": "Replace", "pattern": {"Regex": r"\s+"}, "content": " "}, {"type": "Lowercase"}]
CUT = {"type": "Split", "pattern": {"Regex": r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"}, "behavior": "Removed", "invert": True}
BYTES = {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": False}
#: A letter and an ASCII sign behind it.
LETTER_SIGN = r"(\pL)([!-/:-@\[-`{-~])"


class _Slots(dict):
    """Slot numbers of words; a new word gets the next one and is noted."""

    def __init__(self) -> None:
        super().__init__()
        self.new: list[str] = []

    def __missing__(self, word: str) -> int:
        self.new.append(word)
        self[word] = slot = len(self)
        return slot


def _runs(starts: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Places of runs, one behind the other: each begins at its start and has its number of places."""
    ends = np.cumsum(counts)
    total = int(ends[-1]) if len(ends) else 0
    whole = np.int32 if total < 1 << 31 and starts.max(initial=0) < (1 << 31) - total else np.int64
    out = np.repeat((starts - (ends - counts)).astype(whole), counts)
    out += np.arange(total, dtype=whole)
    return out


class Encoder:
    """Ids of texts by one tokenizer file."""

    def __init__(self, path: str) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark runs one task per core
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(path)
        self.library.encode_special_tokens = True  # special tokens' strings in a text are ordinary text
        self.largest_id = max(self.library.get_vocab().values(), default=0)
        # Whether a space belongs to the word behind it, or spaces leave no trace at all.
        self.spaced = len(self.whole(" a")) != len(self.whole("a")) or bool((self.whole(" a") != self.whole("a")).any())
        # Whether a line's first word has the ids that it has at the start of a text, behind those of the line's end.
        starts = ("a", "A", "1", ".", "'s", "\u00e9", "\u4e2d")
        self.line_starts = all(np.array_equal(self.whole(f"\n{x}"), np.append(self.whole("\n"), self.whole(x))) for x in starts)
        with open(path, encoding="utf-8") as file:
            steps = json.load(file)
        self.apart = (not self.spaced and steps["normalizer"] == {"type": "Sequence", "normalizers": LOWERED}
                      and steps["pre_tokenizer"] == {"type": "Sequence", "pretokenizers": [CUT, BYTES]}
                      and all(token["special"] for token in steps["added_tokens"]))
        self.separator = "\n" if self.spaced else " | "
        ids = self.whole(self.separator)
        self.separator_id = int(ids[0]) if len(ids) == 1 else -1
        self.slots = _Slots()
        self.starts, self.counts, self.uses = np.zeros(1024, np.int64), np.zeros(1024, np.int64), np.zeros(1024, np.int64)
        self.ids, self.used = np.zeros(4096, np.uint32), 0

    def _forget(self) -> None:
        """Keep the words met more than once, at most half of ``REMEMBERED``; their uses count half from now on."""
        uses = self.uses[: len(self.slots)]
        kept = np.flatnonzero(uses > 1)
        if len(kept) > REMEMBERED // 2:
            kept = np.sort(kept[np.argsort(-uses[kept], kind="stable")[: REMEMBERED // 2]])
        words, slots = list(self.slots), _Slots()
        slots.update((words[k], i) for i, k in enumerate(kept.tolist()))
        counts = self.counts[kept]
        starts = np.cumsum(counts) - counts
        total = int(counts.sum())
        self.ids = np.append(self.ids[_runs(self.starts[kept], counts)], np.zeros(4096, np.uint32))
        room = np.zeros(1024, np.int64)
        self.starts, self.counts, self.uses = (np.append(a, room) for a in (starts, counts, uses[kept] // 2))
        self.slots, self.used = slots, total

    def whole(self, text: str) -> np.ndarray:
        return np.array(self.library.encode(text, add_special_tokens=False).ids, np.uint32)

    def _coded(self, words: Sequence[str]) -> tuple[np.ndarray, np.ndarray]:
        """Numbers of ids of each word, and all ids: encoded together where the separator parts them, else one by one."""
        texts = [w[1:] if w[0] == "\x00" else w if w[0] == "\n" else f" {w}" if self.spaced else w for w in words]
        mark = self.separator.strip(" ")
        joined = [t for t in texts if mark not in t] if self.separator_id >= 0 else []
        lots = [self.separator.join([*joined[k : k + JOINED], ""]) for k in range(0, len(joined), JOINED)]
        found = self.library.encode_batch_fast(lots, add_special_tokens=False) if lots else []
        ids = np.concatenate([np.array(f.ids, np.uint32) for f in found]) if found else np.zeros(0, np.uint32)
        ends = np.flatnonzero(ids == self.separator_id)
        if len(ends) == len(joined) == len(texts):
            return np.diff(ends, prepend=-1) - 1, np.delete(ids, ends)
        if len(ends) != len(joined):
            joined, ends = [], ends[:0]
        known = dict(zip(joined, (ids[a:b] for a, b in zip([0, *(ends + 1)], ends, strict=False)), strict=True))
        coded = [known[t] if t in known else self.whole(t) for t in texts]
        return np.fromiter(map(len, coded), np.int64, len(coded)), np.concatenate(coded)

    def _learn(self) -> None:
        words, self.slots.new = self.slots.new, []
        n, first = len(words), len(self.slots) - len(words)
        if not n:
            return
        counts, flat = (np.concatenate(x) for x in zip(*(self._coded(words[k : k + 2000]) for k in range(0, n, 2000)), strict=True))
        while first + n > len(self.starts):
            self.starts, self.counts, self.uses = (np.concatenate([a, np.zeros_like(a)]) for a in (self.starts, self.counts, self.uses))
        while self.used + len(flat) > len(self.ids):
            self.ids = np.concatenate([self.ids, np.zeros_like(self.ids)])
        self.counts[first : first + n] = counts
        self.starts[first : first + n] = self.used + np.cumsum(counts) - counts
        self.ids[self.used : self.used + len(flat)] = flat
        self.used += len(flat)

    def _keys(self, text: str) -> str | None:
        """Keys of a text's words, parted by spaces (a word that no space precedes is marked), or None: encode it whole."""
        if any(c in text for c in UNSURE) or "\x00" in text:
            return None
        if not self.spaced:
            keys = text.replace("\n", " ")
            return " ".join(keys.split()) if keys[:1] == " " or keys[-1:] == " " or "  " in keys else keys
        if text[:1] in (" ", "\n") or text[-1:] in (" ", "\n") or "  " in text or "\n\n" in text or " \n" in text or "\n " in text:
            return None
        return "\x00" + text.replace("\n", " \n \x00" if self.line_starts else " \n") if text else text

    def encode_many(self, texts: Sequence[str]) -> Iterator[np.ndarray]:
        """The ids of whole texts, some texts at a time."""
        start = 0
        while start < len(texts):
            stop, room = start, TOGETHER
            while stop < len(texts) and (room > 0 or stop == start):
                room -= len(texts[stop])
                stop += 1
            yield from self._encode_some(texts[start:stop])
            start = stop

    def _encode_some(self, texts: Sequence[str]) -> list[np.ndarray]:
        if len(self.slots) > REMEMBERED:
            self._forget()
        keys = [self._keys(text) for text in texts]
        lengths = np.zeros(len(texts), np.int64)  # in words
        slots = np.zeros(0, np.int64)
        if at := [k for k, words in enumerate(keys) if words]:
            words = pc.split_pattern(pa.array([keys[k] for k in at], pa.large_string()), " ")
            lengths[at] = pc.list_value_length(words).to_numpy()
            words = words.flatten().dictionary_encode()
            places = words.indices.to_numpy()
            long = pc.greater(pc.utf8_length(words.dictionary), LONG_WORD).to_numpy(zero_copy_only=False)
            if long.any():  # texts with such a word are encoded whole
                whole = np.repeat(np.arange(len(texts)), lengths)[long[places]]
                places = places[~np.isin(np.repeat(np.arange(len(texts)), lengths), whole)]
                lengths[whole] = 0
                for k in np.unique(whole).tolist():
                    keys[k] = None
            names = words.dictionary
            if long.any():
                met, places = np.unique(places, return_inverse=True)
                names = names.take(pa.array(met))
            if self.apart:
                parts = pc.split_pattern(pc.replace_substring_regex(pc.ascii_lower(names), LETTER_SIGN, r"\1 \2"), " ")
                n_parts = pc.list_value_length(parts).to_numpy().astype(np.int64)
                first, n_parts = (np.cumsum(n_parts) - n_parts)[places], n_parts[places]
                lengths = np.diff(np.append(0, np.cumsum(n_parts))[np.append(0, np.cumsum(lengths))])
                parts = parts.flatten().dictionary_encode()
                names = parts.dictionary
                places = parts.indices.to_numpy()[_runs(first, n_parts)]
            names = names.to_numpy(zero_copy_only=False)
            slots = np.fromiter(map(self.slots.__getitem__, names), np.int64, len(names))[places]
        self._learn()
        used = np.bincount(slots, minlength=1)
        self.uses[: len(used)] += used
        counts = self.counts[slots]
        ids = self.ids[_runs(self.starts[slots], counts)]
        bounds = np.append(0, np.cumsum(counts))[np.append(0, np.cumsum(lengths))]
        return [self.whole(t) if k is None else ids[a:b] for t, k, a, b in zip(texts, keys, bounds[:-1], bounds[1:], strict=True)]


def encoder(path: str) -> Encoder:
    """This worker process's encoder of a tokenizer file, with the words it remembers from earlier tasks."""
    held = sys.modules.setdefault("_webloom_encoders", types.ModuleType("_webloom_encoders"))
    if path not in held.__dict__:
        held.__dict__[path] = Encoder(path)
    return held.__dict__[path]


def forget_encoders() -> None:
    """Free what this worker process's encoders remember: later steps of a job may need the memory."""
    held = sys.modules.get("_webloom_encoders")
    for path in [k for k, x in vars(held).items() if isinstance(x, Encoder)] if held else []:
        held.__dict__.pop(path, None)


def tokenizer_path(name: str) -> str:
    """Place of a public tokenizer's file."""
    import public_tokenizers

    return str(public_tokenizers.path(name))


def word_pattern() -> str:
    """The pattern that cuts texts into words before the merges of the public rank files."""
    import public_tokenizers

    return str(public_tokenizers.PATTERN)
