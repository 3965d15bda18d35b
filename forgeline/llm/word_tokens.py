"""Token ids of a word-end BPE tokenizer, through the tokenizers library, with a bounded cache.

The tokenizer drops white space and never joins text across it, so a text's ids are the
ids of its space-separated chunks in a row.  Arrow splits texts into chunks and these into
words and the marks after them; different ones are looked up once a run of texts, and
unseen ones that are plain words take a shorter way through the library.
"""

from __future__ import annotations

import os
import string
from array import array
from functools import lru_cache

import numpy as np
import public_tokenizers
import pyarrow as pa
import pyarrow.compute as pc

WORD_BPE = public_tokenizers.path("word_bpe_49k.json")
CACHED_CHUNKS = 400_000       # entries a worker keeps (some 80 MB); beyond it only those of the texts at hand stay
CACHED_CHARS = 64             # longer chunks are encoded each time


class WordEncoder:
    """``encode(texts)`` gives each text's ids as little-endian unsigned 32-bit bytes.

    Strings that name special tokens are ordinary text, whatever a document holds.
    """

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"     # Spark runs a task per core
        from tokenizers import Tokenizer
        from tokenizers.pre_tokenizers import WhitespaceSplit
        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = True
        spell = self.tokenizer.pre_tokenizer.pre_tokenize_str
        self.spelled = {c: "".join(part for part, _ in spell(chr(c))) for c in range(0x80, 0x250) if chr(c).isalpha()}
        # for spelled-out words in a row, without the normalizer; the last id of a word is marked as such
        self.speller = Tokenizer(self.tokenizer.model)
        self.speller.pre_tokenizer = WhitespaceSplit()
        vocabulary = self.tokenizer.get_vocab()
        self.closes = np.zeros(max(vocabulary.values()) + 1, bool)
        self.closes[[i for token, i in vocabulary.items() if token.endswith(self.tokenizer.model.end_of_word_suffix)]] = True
        self.cache: dict[str, bytes] = {}

    def _ids(self, texts: list[str]) -> list[bytes]:
        return [np.array(e.ids, "<u4").tobytes() for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def _learn(self, chunks: list[str]) -> list[bytes]:
        """Encode different chunks: words of Latin letters by the model alone, others by the whole tokenizer."""
        # of a word of Latin letters the normalizer leaves the lower-case form, which the byte alphabet spells out
        words = [w for w in chunks if w.isalpha()]
        forms = " ".join(words).lower()
        if not forms.isascii():
            if max(forms) >= "ɐ":
                words = [w for w in words if max(w.lower()) < "ɐ"]
                forms = " ".join(words).lower()
            forms = forms.translate(self.spelled)
        new = {}
        if words:
            ids = np.array(self.speller.encode_batch_fast([forms], add_special_tokens=False)[0].ids, "<u4")
            ends = 4 * (np.flatnonzero(self.closes[ids]) + 1)
            if len(ends) == len(words):
                data, ends = ids.tobytes(), ends.tolist()
                new = dict(zip(words, [data[a:b] for a, b in zip([0, *ends], ends)]))
        if len(new) < len(chunks):
            rest = [c for c in chunks if c not in new]
            new.update(zip(rest, self._ids(rest)))
        return [new[c] for c in chunks]

    def _of(self, chunks: list[str]) -> list[bytes]:
        """Ids of different chunks, unseen ones learnt."""
        known = list(map(self.cache.get, chunks))
        unseen = [i for i, ids in enumerate(known) if ids is None]
        if unseen:
            if len(self.cache) + len(unseen) > CACHED_CHUNKS:  # what this run needs stays
                self.cache = {c: ids for c, ids in zip(chunks, known) if ids is not None}
            names = [chunks[i] for i in unseen]
            learnt = self._learn(names)
            for i, ids in zip(unseen, learnt):
                known[i] = ids
            self.cache.update((c, ids) for c, ids in zip(names, learnt) if len(c) <= CACHED_CHARS)
        return known

    def _table(self, *groups: pa.Array) -> pa.LargeListArray:
        """The ids of different chunks, group after group."""
        known = [ids for chunks in groups for ids in self._of(chunks.to_numpy(zero_copy_only=False).tolist())]
        return pa.LargeListArray.from_arrays(_offsets(np.fromiter(map(len, known), np.int64, len(known)) // 4),
                                             pa.array(np.frombuffer(b"".join(known), "<u4")))

    def encode_flat(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts in a row, and where in them each text ends.

        Arrow splits the texts and numbers their different chunks; only words and marks are looked up one by one.
        """
        lists = pc.split_pattern(pc.replace_substring(pa.array([t or "" for t in texts], pa.large_string()), "\n", " "), " ")
        coded = lists.values.dictionary_encode()
        # "word," is "word" and ",": marks after a word are a word of their own if nothing else follows
        chunks = coded.dictionary
        word = pc.utf8_rtrim(chunks, characters=string.punctuation)
        word = pc.if_else(pc.utf8_is_alpha(word), word, chunks)
        words, marks = word.dictionary_encode(), _after(chunks, word).dictionary_encode()
        table = self._table(words.dictionary, marks.dictionary)
        pairs = np.column_stack((words.indices.to_numpy(), len(words.dictionary) + marks.indices.to_numpy())).ravel()
        pairs = table.take(pa.array(pairs))
        rows = pa.LargeListArray.from_arrays(pairs.offsets.take(pa.array(np.arange(0, len(pairs) + 1, 2))), pairs.values).take(coded.indices)
        return rows.values.to_numpy(), rows.offsets.to_numpy()[lists.offsets.to_numpy()[1:]]

    def encode(self, texts: list[str | None]) -> list[bytes]:
        if not texts:
            return []
        ids, ends = self.encode_flat(texts)
        data, ends = ids.tobytes(), (4 * ends).tolist()
        return [data[a:b] for a, b in zip([0, *ends], ends)]


def _offsets(sizes: np.ndarray) -> pa.Array:
    return pa.array(np.concatenate(([0], np.cumsum(sizes, dtype=np.int64))))


def _after(strings: pa.LargeStringArray, starts: pa.LargeStringArray) -> pa.LargeStringArray:
    """What follows in each string after its start."""
    skipped = pc.binary_length(starts).to_numpy()
    sizes = pc.binary_length(strings).to_numpy() - skipped
    offsets = _offsets(sizes)
    first = np.frombuffer(strings.buffers()[1], np.int64)[strings.offset:strings.offset + len(strings)] + skipped
    at = np.repeat(first - offsets.to_numpy()[:-1], sizes) + np.arange(sizes.sum())
    data = np.frombuffer(strings.buffers()[2] or b"", np.uint8)[at]
    return pa.LargeStringArray.from_buffers(len(strings), offsets.buffers()[1], pa.py_buffer(data))


@lru_cache(maxsize=2)
def word_encoder(path: str = WORD_BPE) -> WordEncoder:
    """The encoder of this worker process."""
    return WordEncoder(path)


def slices(texts, most_chars: int = 2_000_000):
    """Arrow texts in runs of bounded length, as lists (one longer text is a run of its own)."""
    run, size = [], 0
    for t in texts:
        t = t.as_py()
        if run and size + len(t or "") > most_chars:
            yield run
            run, size = [], 0
        run.append(t)
        size += len(t or "")
    if run:
        yield run
