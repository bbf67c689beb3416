"""Token ids of whole texts, word by word.

The tokenizer drops white space and never joins characters across it, so the ids of a
text are those of its words between ASCII white space, in order. It also lower-cases, and
parts letters from the signs after them: a word of Latin-1 letters with ASCII signs at its
end has the ids of the lower-case letters, then those of the signs. Any other word is
encoded as it is.

Texts are encoded in runs of some megabytes, as Arrow columns from the split to the ids: a
run's different words are looked up in the worker's table of words; of the others, the
letters go to the tokenizer's model in one call, and as the vocabulary marks a word's last
token, the ids fall apart again. Lower-case letters need no other step before the merges.

The table of words is bounded. When it is full, words stay that came again since the last
time (over half of a corpus's different words occur once).
"""

from __future__ import annotations

import os
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Words in a worker's table, other words and signs in its dictionary, bytes of text in a run.
WORDS, PARTS, RUN_BYTES = 600_000, 50_000, 4_000_000
_LONGEST_KEY = 200
#: Bytes of letters in one call to the model, about; words whose ids are put in place at once.
_CALL, _PLACED = 200_000, 100_000
_LETTERS_SIGNS = r"^(?P<letters>[a-zA-ZÀ-ÖØ-öø-ÿ]+)(?P<signs>[!-/:-@\[-`{-~]*)$"
_LOWER = "abcdefghijklmnopqrstuvwxyz" + "".join(chr(c) for c in (*range(0xDF, 0xF7), *range(0xF8, 0x100)))
_worker: dict[str, WordIds] = {}


def _places(starts: np.ndarray, lens: np.ndarray) -> np.ndarray:
    """The places of pieces ``starts``, ``lens`` of an array, one piece after the other."""
    ends = np.cumsum(lens)
    return np.repeat(starts - (ends - lens), lens) + np.arange(ends[-1] if len(ends) else 0)


class WordIds:
    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer
        from tokenizers.pre_tokenizers import ByteLevel, WhitespaceSplit

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        self.model = Tokenizer(self.tokenizer.model)   # merges alone, of what stands between white space
        self.model.pre_tokenizer = WhitespaceSplit()
        suffix = self.tokenizer.model.end_of_word_suffix
        vocabulary = self.tokenizer.get_vocab(with_added_tokens=False)
        self.last = np.zeros(max(vocabulary.values()) + 1, bool)
        self.last[[i for t, i in vocabulary.items() if suffix and t.endswith(suffix)]] = True
        level = ByteLevel(add_prefix_space=False, use_regex=False)
        self.as_bytes = {ord(c): level.pre_tokenize_str(c)[0][0] for c in _LOWER}
        self.others: dict[str, np.ndarray] = {}
        self.words = pa.array([], pa.string())   # with their ids: pieces of ``flat``
        self.flat, self.lens, self.again = np.zeros(0, "<u4"), np.zeros(0, np.int64), np.zeros(0, bool)

    def runs(self, column: pa.Array) -> Iterator[tuple[int, list[bytes]]]:
        """Of a column of UTF-8 texts, run by run: the place of its first text, and for each text
        its ids as bytes (``<u4``). Null has none."""
        sizes = pc.fill_null(pc.binary_length(column), 0).to_numpy(zero_copy_only=False)
        start, held = 0, 0
        for i, n in enumerate(sizes.tolist()):
            held += n
            if held >= RUN_BYTES or i == len(sizes) - 1:
                found = self._run(column.slice(start, i + 1 - start))
                pa.default_memory_pool().release_unused()   # else the pool keeps several times what is held
                yield start, found
                start, held = i + 1, 0

    def _run(self, column: pa.Array) -> list[bytes]:
        try:
            texts = pc.fill_null(column.cast(pa.string()), "")
        except pa.ArrowInvalid:   # not all are UTF-8
            texts = pa.array([(t or b"").decode("utf-8", "replace") for t in column.to_pylist()], pa.string())
        split = pc.ascii_split_whitespace(texts)
        found = split.flatten().dictionary_encode()
        different, codes = found.dictionary, found.indices.to_numpy(zero_copy_only=False)
        known = pc.fill_null(pc.index_in(different, value_set=self.words), -1).to_numpy(zero_copy_only=False).astype(np.int64)
        offsets = split.offsets.to_numpy()
        offsets = offsets - offsets[0]
        del texts, split, found
        is_new = known < 0
        new = different.filter(pa.array(is_new))
        new_flat, new_lens = self._encoded(new)
        flat, lens = np.concatenate([self.flat, new_flat]), np.concatenate([self.lens, new_lens])
        place = known.copy()
        place[is_new] = len(self.lens) + np.arange(len(new_lens))
        lens_of, starts_of = lens[place], (np.cumsum(lens) - lens)[place]
        ends = np.concatenate([[0], np.cumsum(lens_of[codes])])
        ids = np.empty(ends[-1], "<u4")
        for a in range(0, len(codes), _PLACED):
            some = codes[a : a + _PLACED]
            ids[ends[a] : ends[a + len(some)]] = flat[_places(starts_of[some], lens_of[some])]
        self.again[known[~is_new]] = True
        self._keep(new, new_flat, new_lens, np.bincount(codes, minlength=len(different))[is_new] > 1)
        at = ends[offsets].tolist()
        return [ids[a:b].tobytes() for a, b in zip(at, at[1:], strict=False)]

    def _keep(self, new: pa.Array, flat: np.ndarray, lens: np.ndarray, again: np.ndarray) -> None:
        def chosen(words, flat, lens, again, mask):
            return words.filter(pa.array(mask)), flat[np.repeat(mask, lens)], lens[mask], again[mask]

        short = pc.binary_length(new).to_numpy(zero_copy_only=False) <= _LONGEST_KEY
        new, flat, lens, again = chosen(new, flat, lens, again, short)
        old = (self.words, self.flat, self.lens, self.again)
        if len(old[0]) + len(new) > WORDS:
            old = chosen(*old, old[3])
            old[3][:] = False
            room = max(0, WORDS - len(old[0]))
            if len(new) > room:
                new, flat, lens, again = chosen(new, flat, lens, again, again)
                first = np.arange(len(new)) < room
                new, flat, lens, again = chosen(new, flat, lens, again, first)
        self.words = pa.concat_arrays([old[0], new])
        self.flat, self.lens, self.again = np.concatenate([old[1], flat]), np.concatenate([old[2], lens]), np.concatenate([old[3], again])

    def _encoded(self, words: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """The ids of different words, one after the other, and how many each has."""
        if not len(words):
            return np.zeros(0, "<u4"), np.zeros(0, np.int64)
        parts = pc.extract_regex(words, _LETTERS_SIGNS)
        usual = pc.is_valid(parts).to_numpy(zero_copy_only=False)
        found = parts.filter(pa.array(usual))
        letters = pc.utf8_lower(found.field("letters")).dictionary_encode()
        signs = found.field("signs").dictionary_encode()
        flat, lens = self._letters(letters.dictionary)
        rest = [self._other(x) for x in (*signs.dictionary.to_pylist(), *words.filter(pa.array(~usual)).to_pylist())]
        flat = np.concatenate([flat, *rest])
        lens = np.concatenate([lens, np.array([len(x) for x in rest], np.int64)])
        # each word as two pieces: letters and signs, or itself and nothing
        n_letters, n_signs = len(letters.dictionary), len(signs.dictionary)
        pieces = np.zeros((len(words), 2), np.int64)
        pieces[usual, 0] = letters.indices.to_numpy(zero_copy_only=False)
        pieces[usual, 1] = n_letters + signs.indices.to_numpy(zero_copy_only=False)
        pieces[~usual, 0] = n_letters + n_signs + np.arange(int((~usual).sum()))
        each = lens[pieces]
        each[~usual, 1] = 0
        starts = (np.cumsum(lens) - lens)[pieces]
        return flat[_places(starts.ravel(), each.ravel())], each.sum(axis=1)

    def _other(self, text: str) -> np.ndarray:
        """Ids of signs, or of a word of another kind."""
        data = self.others.get(text)
        if data is None:
            data = np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, "<u4")
            if len(self.others) >= PARTS:
                self.others.clear()
            if len(text) <= _LONGEST_KEY:
                self.others[text] = data
        return data

    def _letters(self, strings: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """As :meth:`_encoded`, of strings of lower-case Latin-1 letters."""
        sizes = pc.binary_length(strings).to_numpy(zero_copy_only=False).astype(np.int64) + 1
        call = np.cumsum(sizes) // _CALL
        edges = [0, *(np.flatnonzero(np.diff(call)) + 1).tolist(), len(sizes)]
        flat, lens = [np.zeros(0, "<u4")], [np.zeros(0, np.int64)]
        for a, b in zip(edges, edges[1:], strict=False):
            if a == b:
                continue
            text = "\n".join(strings.slice(a, b - a).to_pylist())
            text = text if text.isascii() else text.translate(self.as_bytes)
            ids = np.array(self.model.encode_batch_fast([text], add_special_tokens=False)[0].ids, "<u4")
            n = np.diff(np.flatnonzero(self.last[ids]) + 1, prepend=0)
            if len(n) != b - a:   # a vocabulary without marks: each by itself
                each = [[t.id for t in self.tokenizer.model.tokenize(x)] for x in text.split("\n")]
                ids, n = np.array([t for x in each for t in x], "<u4"), np.array([len(x) for x in each], np.int64)
            flat.append(ids)
            lens.append(n)
        return np.concatenate(flat), np.concatenate(lens)


def word_ids(path: str) -> WordIds:
    """One encoder per Python worker and vocabulary file."""
    if path not in _worker:
        _worker[path] = WordIds(path)
    return _worker[path]
