"""Token ids of whole texts by the ``tokenizers`` library, each distinct word encoded once.

The tokenizer drops white space and never joins characters across it, so a text's ids are the ids of its words in a row.
A Python worker remembers the words it has met, up to ``MAX_WORDS``; then it starts over.
"""

from __future__ import annotations

from .common import kept
from .idstore import IdStore

MAX_WORDS = 600_000
END_ID = 1
END = " "  # stands for the end of a text: no word has a space


def word_encoder(path: str | None = None, end_id: int = END_ID, max_words: int = MAX_WORDS) -> "WordEncoder":
    """The encoder of this Python worker; ``path`` None is the 49k word vocabulary of ``public_tokenizers``."""
    return kept(("words", path, end_id), lambda: WordEncoder(path, end_id, max_words))


class WordEncoder:
    def __init__(self, path: str | None = None, end_id: int = END_ID, max_words: int = MAX_WORDS):
        import public_tokenizers
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(path or public_tokenizers.path("word_bpe_49k.json"))
        self.end_id, self.max_words = end_id, max_words
        shown = [*range(33, 127), *range(161, 173), *range(174, 256)]  # fixed: how byte-level vocabularies spell bytes
        rest = [b for b in range(256) if b not in set(shown)]
        self.spelling = {b: 256 + k for k, b in enumerate(rest)}
        # a full stop or comma after letters is a piece of its own
        self.tails = {c: tuple(self.library.encode(c, add_special_tokens=False).ids) for c in ".,"}
        self.spelt = {ids: c for c, ids in self.tails.items()} | {(): ""}
        self._reset()

    def _reset(self):
        self.store = IdStore()
        self.store.add(["", END], [[], [self.end_id]])

    def _learn(self, words: list[str]):
        """A word of letters is one piece to the tokenizer, and so is a full stop or comma after it; the library's model cuts
        each piece into tokens. Words of any other kind go through the whole tokenizer."""
        plain, tails, others = [], [], []
        for w in words:
            tail = self.tails.get(w[-1])
            stem = w if tail is None else w[:-1]
            if stem.isalpha():
                plain.append(stem)
                tails.append(tail or ())
            else:
                others.append(w)
        normal = self.library.normalizer.normalize_str(" ".join(plain)).split(" ") if plain else []
        if len(normal) != len(plain) or not all(map(str.isalpha, normal)):  # rare: a letter whose lower case has a mark
            normal = [self.library.normalizer.normalize_str(w) for w in plain]
        cut, ids, kept = self.library.model.tokenize, [], []
        for stem, n, tail in zip(plain, normal, tails):
            w = stem + self.spelt[tail]
            if n.isalpha():
                kept.append(w)
                ids.append([*[t.id for t in cut(n if n.isascii() else n.encode().decode("latin-1").translate(self.spelling))], *tail])
            else:
                others.append(w)
        self.store.add(kept, ids)
        self.store.add(others, [self.library.encode(w, add_special_tokens=False).ids for w in others])

    def encode(self, texts):
        """(ids of all texts in a row as uint32, the end of each text in them) of an Arrow string array; the end id closes
        each text and a null is empty."""
        import numpy as np
        import pyarrow.compute as pc

        if len(self.store.known) > self.max_words:
            self._reset()
        texts = texts.fill_null("")
        special = pc.any(pc.match_substring(texts, "<|")).as_py()  # special tokens keep their case
        lists = pc.ascii_split_whitespace(texts if special else pc.ascii_lower(texts))
        until = lists.offsets.to_numpy()
        coded = lists.values[until[0]:until[-1]].dictionary_encode()
        numbers = np.array(self.store.numbers(coded.dictionary.to_pylist(), self._learn), np.int64)
        until = until.astype(np.int64) - until[0]
        end = until[1:] + np.arange(len(texts))  # the word after a text's last one is its end
        row = np.full(len(coded) + len(texts), self.store.known[END], np.int64)
        inside = np.ones(len(row), bool)
        inside[end] = False
        row[inside] = numbers[coded.indices.to_numpy(zero_copy_only=False)]
        ids, after = self.store.gather(row)
        return ids, after[end]
