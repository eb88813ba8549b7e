"""Public tokenizers with a cache by word.

Both tokenizers split at white space first, so the ids of a text are the ids
of its words in order.  Words repeat, so each Python worker keeps the ids of
the words that it met (bounded; an overfull cache starts anew).  A text with a
character on which the splits could differ goes through the tokenizer whole.
"""

from __future__ import annotations

import os
import re

import numpy as np

from vigil.llm.common import only

WORD_CACHE = 800_000
PIECE_CACHE = 1_000_000

# str.split() cuts at these, the tokenizer does not.
_ODD = re.compile("[\x1c-\x1f]")
# from here on composition and lower-casing can look at more than one character
_LATER = re.compile("[^\x00-\u012f]")


class Cache:
    """Values of keys seen before.  When full, the newer half becomes the older one, whose keys come back on use."""

    def __init__(self, size: int):
        self.size, self.new, self.old = size // 2, {}, {}

    def take(self, lists: list[list[str]], learn) -> list[list]:
        """The values of the keys of each list; ``learn`` gives those of a list of unknown keys."""
        if len(self.new) > self.size:
            self.new, self.old = {}, self.new
        known = self.new
        found = [list(map(known.get, keys)) for keys in lists]
        late = [i for i, f in enumerate(found) if None in f]
        missing = {k for i in late for k, x in zip(lists[i], found[i]) if x is None}
        if self.old:
            known.update((k, self.old[k]) for k in missing & self.old.keys())
            missing -= known.keys()
        if missing:
            missing = list(missing)
            known.update(zip(missing, learn(missing)))
        for i in late:
            found[i] = list(map(known.__getitem__, lists[i]))
        return found


class WordBpe:
    """ids of ``word_bpe_49k.json`` (lower-casing BPE with word ends).

    The tokenizer cuts lower-cased text into pieces (letters, single digits, marks, contractions) and encodes each
    alone; here pieces are cut in bulk by spaces put around all that is not letters, and known pieces are kept.
    """

    CUT = r"'(?:[stmd]|re|ve|ll)|\p{N}|[^\s\p{L}\p{N}]+"
    CUT_ASCII = r"'(?:[stmd]|re|ve|ll)|[0-9]|[^\sa-z0-9]+"
    WHOLE = "\x1f"  # marks a key that is a word to be encoded as it stands; no other key holds it

    def __init__(self, path: str):
        import regex
        from tokenizers import Tokenizer

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        self.tok = Tokenizer.from_file(path)
        self.cut, self.cut_ascii = regex.compile(self.CUT).sub, re.compile(self.CUT_ASCII, re.ASCII).sub
        vocab = self.tok.get_vocab()
        self.last = np.zeros(max(vocab.values()) + 1, bool)
        self.last[[i for t, i in vocab.items() if t.endswith("</w>")]] = True
        special = [re.escape(x.content) for x in self.tok.get_added_tokens_decoder().values()]
        self.odd = re.compile("|".join([_ODD.pattern, *special]))
        self.pieces = Cache(PIECE_CACHE)

    def direct(self, text: str) -> bytes:
        return np.array(self.tok.encode(text, add_special_tokens=False).ids, "<u4").tobytes()

    def cut_up(self, text: str) -> list[str]:
        """Pieces of a text, in order."""
        if text.isascii():
            return self.cut_ascii(r" \g<0> ", text.lower()).split()
        if not _LATER.search(text):
            return self.cut(r" \g<0> ", text.lower()).split()
        return [p for w in text.split() for p in ([self.WHOLE + w] if _LATER.search(w) else self.cut_up(w))]

    def _learn(self, new: list[str]) -> list[bytes]:
        out = {p: self.direct(p[1:]) for p in new if p[0] == self.WHOLE}
        cut = [p for p in new if p[0] != self.WHOLE]
        for i in range(0, len(cut), 512):
            part = cut[i:i + 512]
            ids = np.array(self.tok.encode(" ".join(part), add_special_tokens=False).ids, "<u4")
            ends = np.flatnonzero(self.last[ids]) + 1
            if len(ends) == len(part) and (not len(ids) or ends[-1] == len(ids)):
                raw, hi = ids.tobytes(), (4 * ends).tolist()
                out.update(zip(part, [raw[a:b] for a, b in zip([0, *hi], hi)]))
            else:
                out.update((p, self.direct(p)) for p in part)
        return [out[p] for p in new]

    def encode(self, texts: list[str]) -> list[bytes]:
        """Little-endian uint32 ids of each text."""
        whole = [bool(self.odd.search(t)) for t in texts]
        found = self.pieces.take([[] if w else self.cut_up(t) for t, w in zip(texts, whole)], self._learn)
        return [self.direct(t) if w else b"".join(f) for t, w, f in zip(texts, whole, found)]


def _by_word(texts: list[str], words: dict[str, bytes], learn, whole) -> list[bytes]:
    split = [None if _ODD.search(t) else t.split() for t in texts]
    found = [list(map(words.get, s)) if s else [] for s in split]
    late = [i for i, f in enumerate(found) if None in f]
    if late:
        new = {w for i in late for w, x in zip(split[i], found[i]) if x is None}
        if len(words) + len(new) > WORD_CACHE:
            words.clear()
            new = {w for i in late for w in split[i]}
        learn(new)
        for i in late:
            found[i] = map(words.__getitem__, split[i])
    return [whole(t) if s is None else b"".join(f) for t, s, f in zip(texts, split, found)]


class PieceBpe:
    """ids of ``piece_bpe_32k.model`` (BPE with byte fallback)."""

    def __init__(self, path: str):
        import sentencepiece

        self.sp = sentencepiece.SentencePieceProcessor(model_file=path)
        self.is_byte = np.array([self.sp.is_byte(i) for i in range(self.sp.get_piece_size())])
        self.words: dict[str, bytes] = {}

    def _learn(self, new: set[str]) -> None:
        new = list(new)
        for w, ids in zip(new, self.sp.encode(new, num_threads=1)):
            self.words[w] = np.array(ids, "<u4").tobytes()

    def encode(self, texts: list[str]) -> list[bytes]:
        """Little-endian uint32 ids of each text, word by word."""
        return _by_word(texts, self.words, self._learn, lambda t: b"".join(self.encode(t.split())))


def opened(kind, path: str):
    """One tokenizer of a kind in each Python worker."""
    return only((kind.__name__, path), lambda: kind(path))


def vocabulary(name: str) -> str:
    """Place of a public vocabulary file on this machine; a file name with a folder is taken as it is."""
    if os.sep in name:
        return name
    import public_tokenizers

    return str(public_tokenizers.path(name))
