"""Whole texts to ids by a public tokenizer, each distinct word encoded once.

The vocabularies split a text before they merge: no merge crosses white space, nor the place between a letter or digit
and a full stop or comma. So a text can be encoded word by word, a closing mark apart, and the ids of a word kept. New words are encoded many a call, with bars between them, whose id shows where words part. The
words of a text are told apart at single spaces only where that is safe; other texts (runs of white space, rare
separators) go to the tokenizer as they are.
"""

from __future__ import annotations

import os

import numpy as np

from linetally.llm.common import give_back

#: Bytes of words and ids kept while a task runs, with what a dictionary entry takes beside them.
KEPT_BYTES = 64 << 20
ENTRY_BYTES = 170
#: Texts are cut into parts of about so many characters, at a place where words part.
PART = 1 << 20
#: Words per call.
PER_CALL = 256
#: Stands between new words; its id shows where they part.
BAR = "|"

#: White space that may read otherwise beside a space than alone.
_ODD = ("  ", "\n ", *map(chr, (9, 11, 12, 13, 28, 29, 30, 31, 0x85, 0xA0, 0x1680, 0x180E, *range(0x2000, 0x200C), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000, 0xFEFF)))
_READERS: dict[tuple, "WordTokenizer"] = {}


def plain(text: str) -> bool:
    """Whether each word reads the same alone as in the text."""
    return not any(x in text for x in _ODD)


class WordTokenizer:
    """``ids(text)``: what ``encode(text, add_special_tokens=False)`` gives; special tokens' strings are plain text."""

    def __init__(self, path: str, kept_bytes: int = KEPT_BYTES):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = True
        self.dtype = np.dtype("<u2" if self.tokenizer.get_vocab_size() <= 1 << 16 else "<u4")
        alone, bars = self._fast(f" word {BAR} word"), [int(x) for x in np.frombuffer(self._encode(f"{BAR} {BAR}"), self.dtype)[1:]]
        self.bar = bars[0] if len(bars) == 1 and (np.array(alone.ids) == bars[0]).sum() == 1 else None
        self.marks = {m: self._encode(m) for m in ".,"}
        self.kept_bytes, self.held = kept_bytes, 0
        self.kept: dict[str, bytes] = {}

    def _encode(self, text: str) -> bytes:
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, self.dtype).tobytes()

    def _fast(self, text: str):
        """What ``encode`` gives, without offsets, which take almost half of its time."""
        return self.tokenizer.encode_batch_fast([text], add_special_tokens=False)[0]

    def _learn(self, words: list[str]) -> None:
        """Keep the ids of new words, many words a call."""
        step = self.dtype.itemsize
        barred = words if self.bar is None else [w for w in words if BAR in w]
        if barred:
            words = list(set(words).difference(barred))
        for parted, names in ((self._by_bars, words), (self._by_offsets, barred)):
            for at in range(0, len(names), PER_CALL):
                some = names[at : at + PER_CALL]
                ids, begins, ends = parted(some)
                data = ids.tobytes()
                self.kept.update(zip(some, [data[a:b] for a, b in zip((begins * step).tolist(), (ends * step).tolist(), strict=True)], strict=True))

    # each: the ids of some words, and where those of each word begin and end

    def _by_bars(self, words: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Words without a bar."""
        ids = np.array(self._fast(f" {f' {BAR} '.join(words)}").ids, self.dtype)
        bars = np.flatnonzero(ids == self.bar)
        if len(bars) != len(words) - 1:
            return self._by_offsets(words)
        return ids, np.concatenate([[0], bars + 1]), np.concatenate([bars, [len(ids)]])

    def _by_offsets(self, words: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Any words; a token belongs to the word where it begins."""
        read = self.tokenizer.encode(f" {' '.join(words)}", add_special_tokens=False)
        starts = np.cumsum([0, *(len(w) + 1 for w in words)])
        cuts = np.searchsorted([x[0] for x in read.offsets], starts)
        return np.array(read.ids, self.dtype), cuts[:-1], cuts[1:]

    def _words(self, texts: list[list[str]]) -> list[np.ndarray]:
        """Ids of plain texts, given as words; the first word of each has no space before it."""
        seen = set()
        for words in texts:
            seen.update(words[1:])
        unseen = seen.difference(self.kept)
        marked = [w for w in unseen if w[-1:] in self.marks and w[-2:-1].isalnum() and w[-2] < "\x80"]
        stems = {w[:-1] for w in marked}
        more = sum(2 * len(w) + ENTRY_BYTES for w in unseen | stems.difference(self.kept))  # a word takes about as many bytes again for its ids
        if self.held and self.held + more > self.kept_bytes:
            # the words of these texts stay: the frequent ones are among them
            self.kept = {w: self.kept[w] for w in seen.difference(unseen) | stems.intersection(self.kept)}
            self.held = sum(2 * len(w) + ENTRY_BYTES for w in self.kept)
            give_back()
        self._learn(list((unseen.difference(marked) | stems).difference(self.kept)))
        self.kept.update((w, self.kept[w[:-1]] + self.marks[w[-1]]) for w in marked)
        self.held += more
        find = self.kept.__getitem__
        return [np.frombuffer(b"".join([self._encode(words[0]), *map(find, words[1:])]), self.dtype) for words in texts]

    def forget(self) -> None:
        """Drop the words; called at a task's end, since idle workers would keep them."""
        self.kept, self.held = {}, 0
        give_back()

    def many(self, texts: list[str | None]) -> list[np.ndarray]:
        """The ids of each text; null as the empty text."""
        out: list[np.ndarray] = [np.zeros(0, self.dtype)] * len(texts)
        easy = []
        for i, text in enumerate(texts):
            if not text:
                continue
            if not plain(text):
                out[i] = np.frombuffer(self._encode(text), self.dtype)
            elif len(text) > 2 * PART:
                out[i] = self._long(text)
            else:
                easy.append(i)
        for i, ids in zip(easy, self._words([texts[i].split(" ") for i in easy]), strict=True):
            out[i] = ids
        return out

    def _long(self, text: str) -> np.ndarray:
        parts, at = [], 0
        while at < len(text):
            # " word" starts a part, so each part reads as it does inside the text
            cut = text.find(" ", at + PART)
            cut = len(text) if cut < 0 else cut
            parts += self._words([text[at:cut].split(" ")])
            at = cut
        return np.concatenate(parts)

    def ids(self, text: str | None) -> np.ndarray:
        return self.many([text])[0]


def word_tokenizer(path: str) -> WordTokenizer:
    """One tokenizer per worker and file, with the words its task has seen."""
    key = (path, os.getpid())
    if key not in _READERS:
        _READERS[key] = WordTokenizer(path)
    return _READERS[key]
