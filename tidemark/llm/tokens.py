"""Token ids of whole texts by a public tokenizer, with a bounded cache of words.

The tokenizer's byte-level pattern never joins text across a single space with other characters on both sides, so a
text falls into words there. A single line break between other characters parts words as well; the word behind it has
no space before it. Texts with other runs of white space are cut at such spaces and breaks only. The pattern also parts
letters from punctuation behind them, so a word of letters with a tail of punctuation has the ids of the letters, then
those of the tail. Words of any other form are encoded as they are. The ids are those of the whole text.

Arrow splits a part's texts and tells its distinct words; only these become Python strings, without their tails. They have
numbers in the cache, and each distinct one is encoded once per cache, many at a time. The ids of the part are gathered from
those of its distinct words. The cache is bounded in words and characters, so a worker stays small whatever it reads: when it
is full, the words that were met most often stay, half of it at most. Between tasks a worker keeps an eighth: most words are
met in few texts, and idle workers share an executor's memory with other stages.
"""

from __future__ import annotations

import itertools
import os
import pickle
import re
from collections.abc import Iterator

import numpy as np

from tidemark.llm.wordhash import give_back

ID_BYTES = 4
#: How byte-level vocabularies write a space and a line break.
SPACE, LINE = "\u0120", "\u010a"
#: Words and characters a worker's cache may hold before its rarer words go.
CACHE_WORDS, CACHE_CHARS = 500_000, 6_000_000
#: Letters before this one (Latin, Greek and Cyrillic) are letters to every version of Unicode in use; words with others go the general way.
FIRST_OTHER = "\u0530"
#: A text's first word has this before it while texts are split, which no other word has: white space behind a space is uneven.
FIRST = "\x1f"
_WHITE = "\t-\r\x1c- \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
_UNEVEN = f"[{_WHITE}]{{2}}"
_CUT = re.compile(r"(?<=\S) (?=\S)|(?<=\S)(?=\n\S)")
#: Neither white space nor letter nor digit, and no apostrophe, which may begin a contraction.
_TAIL = "!\"#$%&()*+,-./:;<=>?@[\\]^_`{|}~"
#: Letters, then a tail if any.
_PLAIN = f"^[{FIRST}\n]?[{''.join(filter(str.isalpha, map(chr, range(ord(FIRST_OTHER)))))}]+[{re.escape(_TAIL)}]*$"
#: Words that are encoded at once.
_CHUNK = 4096


def _byte_letters() -> list[str]:
    """How byte-level vocabularies write each byte: visible characters as themselves, the others in order from U+0100 on."""
    visible = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    hidden = [b for b in range(256) if b not in visible]
    return [chr(b) if b in visible else chr(0x100 + hidden.index(b)) for b in range(256)]


#: A space stays itself, as it parts words.
_BYTE_LETTERS = {**dict(enumerate(_byte_letters())), ord(" "): " "}


def vocabulary_path(name: str = "byte_bpe_50k.json") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


class _Numbers(dict):
    """Numbers of words, given out as they are asked for."""

    def __missing__(self, word: str) -> int:
        n = self[word] = len(self)
        return n


def _ranges(values: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """``sizes[i]`` values from ``starts[i]`` on, for each i, one after the other."""
    # Each value's place: its range's start, and how far into the range it is.
    return values[np.repeat(starts - (np.cumsum(sizes) - sizes), sizes) + np.arange(sizes.sum())]


def _split(texts):
    """Lists of the words of ``texts``, an Arrow array without nulls. A text's first word has ``FIRST`` before it, a line's has its line break."""
    import pyarrow as pa
    import pyarrow.compute as pc

    marked = pc.binary_join_element_wise(pa.scalar(FIRST, texts.type), texts, pa.scalar("", texts.type))
    uneven = pc.match_substring_regex(texts, _UNEVEN)
    odd = np.flatnonzero(uneven.to_numpy(zero_copy_only=False))
    if not len(odd):
        return pc.split_pattern(pc.replace_substring(marked, "\n", " \n"), " ")
    even = np.flatnonzero(pc.invert(uneven).to_numpy(zero_copy_only=False))
    split = pc.split_pattern(pc.replace_substring(marked.take(pa.array(even)), "\n", " \n"), " ")
    cut = [_CUT.split(t) for t in texts.take(pa.array(odd)).to_pylist()]
    for words in cut:
        words[0] = FIRST + words[0]
    return pa.concat_arrays([split, pa.array(cut, split.type)]).take(pa.array(np.argsort(np.append(even, odd))))


class Encoder:
    """Texts to 32-bit ids."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer, pre_tokenizers

        self._tokenizer = Tokenizer.from_file(path)
        # The same model on pieces of the tokenizer's own pattern, in byte letters and with spaces between them.
        self._pieces = Tokenizer(self._tokenizer.model)
        self._pieces.pre_tokenizer = pre_tokenizers.WhitespaceSplit()
        # Whether an id begins with a space, or is a line break.
        vocabulary = self._tokenizer.get_vocab()
        self._heads = np.zeros(1 + max(vocabulary.values()), bool)
        self._heads[[i for w, i in vocabulary.items() if w[:1] == SPACE or w == LINE]] = True
        # A key that begins with a space is a text's first word or a tail, with a line break a line's, any other one a word after a space.
        self._numbers = _Numbers()
        self._ids_of, self._starts, self._sizes, self._uses = np.empty(0, np.uint32), np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0, np.int64)
        self._chars = 0

    def _forget(self, part: int = 2) -> None:
        """Keep the words that were met most often, up to one ``part`` of what the cache may hold. Their uses count half from now on."""
        words, often = list(self._numbers), np.argsort(-self._uses, kind="stable")
        sizes = np.fromiter(map(len, words), np.int64, len(words))
        n = min(CACHE_WORDS // part, int(np.searchsorted(np.cumsum(sizes[often]), CACHE_CHARS // part, "right")))
        kept = np.sort(often[:n])
        self._ids_of, self._sizes, self._chars = self._gathered(kept), self._sizes[kept], int(sizes[kept].sum())
        self._starts, self._uses = np.cumsum(self._sizes) - self._sizes, self._uses[kept] // 2
        # Made anew behind the freed words, so that they do not hold on to memory all over the place.
        written = pickle.dumps(list(map(words.__getitem__, kept.tolist())))
        del words
        self._numbers = _Numbers()
        self._numbers.update(zip(pickle.loads(written), range(n)))

    def _gathered(self, number: np.ndarray) -> np.ndarray:
        """The ids of the words with these numbers, one after the other."""
        return _ranges(self._ids_of, self._starts[number], self._sizes[number])

    def _encoded(self, texts: list[str]) -> list[list[int]]:
        return [e.ids for e in self._tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def _letters(self, words: list[str], before: str) -> tuple[list[np.ndarray], list[np.ndarray]]:
        """The ids of runs of letters behind ``SPACE`` (one piece with it) or ``LINE`` and a space (two), and how many each has, in chunks."""
        flat, sizes = [], []
        for at in range(0, len(words), _CHUNK):
            written = " ".join(words[at : at + _CHUNK]).encode().decode("latin-1").translate(_BYTE_LETTERS)
            (found,) = self._pieces.encode_batch_fast([before + written.replace(" ", " " + before)], add_special_tokens=False)
            flat.append(np.array(found.ids, np.uint32))
            sizes.append(np.diff(np.append(np.flatnonzero(self._heads[flat[-1]]), len(flat[-1]))))
        return flat, sizes

    def _learn(self, plain: np.ndarray) -> None:
        """Encode the words that have numbers and no ids yet. ``plain`` tells which of them are letters."""
        known = len(self._starts)
        new = list(itertools.islice(self._numbers, known, None))
        kinds: tuple[list[int], list[int], list[int]] = [], [], []  # after a space, first of a text or line, not of letters
        for i, (w, letters) in enumerate(zip(new, plain.tolist(), strict=True)):
            kinds[w[0] in " \n" if letters else 2].append(i)
        spaced, led, later = kinds
        others = self._encoded([w[1:] if w[:1] == " " else w if w[:1] == "\n" else " " + w for w in map(new.__getitem__, later)])
        found = (
            self._letters([new[i] for i in spaced], SPACE), self._letters([new[i][1:] for i in led], LINE + " "),
            ([np.array(list(itertools.chain.from_iterable(others)), np.uint32)], [np.fromiter(map(len, others), np.int64, len(others))]),
        )
        ids = np.concatenate([part for flat, _ in found for part in flat])
        order, size = np.array(spaced + led + later, np.int64), np.concatenate([part for _, sizes in found for part in sizes])
        starts, sizes = np.empty(len(new), np.int64), np.empty(len(new), np.int64)
        starts[order], sizes[order] = np.cumsum(size) - size, size
        first = [i for i in led if new[i][0] == " "]  # a text's first word is found behind a line break too, which it does not have
        starts[first] += 1
        sizes[first] -= 1
        self._starts = np.concatenate([self._starts, starts + len(self._ids_of)])
        self._sizes = np.concatenate([self._sizes, sizes])
        self._ids_of = np.concatenate([self._ids_of, ids])
        self._uses = np.concatenate([self._uses, np.zeros(len(new), np.int64)])
        self._chars += sum(map(len, new))

    def encode_flat(self, texts, end_id: int | None = None) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all ``texts`` (an Arrow array, null is empty) one after the other, each with ``end_id`` behind it if given, and how many each has."""
        import pyarrow as pa
        import pyarrow.compute as pc

        if len(self._numbers) > CACHE_WORDS or self._chars > CACHE_CHARS:
            self._forget()
        if not len(texts):
            return np.empty(0, np.uint32), np.empty(0, np.int64)
        split = _split(pc.fill_null(texts.cast(pa.large_string()), ""))
        ends, coded = np.asarray(split.offsets).astype(np.int64), split.values.dictionary_encode()
        distinct, word = coded.dictionary, coded.indices.to_numpy()
        plain = pc.match_substring_regex(distinct, _PLAIN)
        stems = pc.if_else(plain, pc.ascii_rtrim(distinct, characters=_TAIL), distinct)
        tail_size = pc.subtract(pc.binary_length(distinct), pc.binary_length(stems)).to_numpy()
        tailed = np.flatnonzero(tail_size)
        stems = stems.dictionary_encode()
        stem, keys = stems.indices.to_numpy(), stems.dictionary.to_numpy(zero_copy_only=False).tolist()
        for i in set(stem[word[ends[:-1]]].tolist()):
            keys[i] = " " + keys[i][1:]
        tails = [" " + w[-n:] for w, n in zip(distinct.take(pa.array(tailed)).to_numpy(zero_copy_only=False).tolist(), tail_size[tailed].tolist())]

        known = len(self._starts)
        number_of = self._numbers.__getitem__
        key = np.fromiter(map(number_of, keys), np.int64, len(keys))[stem]
        tail = np.fromiter(map(number_of, tails), np.int64, len(tails))
        if len(self._numbers) > known:
            letters = np.zeros(len(self._numbers), bool)
            letters[key[plain.to_numpy(zero_copy_only=False)]] = True
            self._learn(letters[known:])
        # The distinct words' numbers, each with its tail's behind it.
        parts = 1 + (tail_size > 0)
        head = np.cumsum(parts) - parts
        number = np.empty(parts.sum(), np.int64)
        number[head], number[head[tailed] + 1] = key, tail
        met = np.bincount(word, minlength=len(distinct))
        self._uses += np.bincount(number, np.repeat(met, parts), len(self._uses)).astype(np.int64)

        sizes = np.add.reduceat(self._sizes[number], head)
        flat = _ranges(self._gathered(number), (np.cumsum(sizes) - sizes)[word], sizes[word])
        stops = np.append(0, np.cumsum(sizes[word]))[ends[1:]]
        counts = np.diff(np.append(0, stops))
        if end_id is not None:
            flat, counts = np.insert(flat, stops, end_id), counts + 1
        return flat, counts

    def encode(self, texts: list[str]) -> list[bytes]:
        """The ids of each text as little-endian bytes. ``texts`` should be a bounded batch."""
        import pyarrow as pa

        flat, counts = self.encode_flat(pa.array(texts, pa.large_string()))
        return [part.astype("<u4").tobytes() for part in np.split(flat, np.cumsum(counts)[:-1])] if texts else []


_ENCODERS: dict[str, Encoder] = {}


def encoder(path: str) -> Encoder:
    """The worker's encoder for a vocabulary file; its cache lives as long as the worker."""
    if path not in _ENCODERS:
        _ENCODERS[path] = Encoder(path)
    return _ENCODERS[path]


def encoded(batches: Iterator, path: str, end_id: int, text: str = "text", size: int = 500_000) -> Iterator:
    """(part of an Arrow batch, ids of its rows one after the other, ids per row); each row ends with ``end_id``.

    Parts hold about ``size`` bytes of text. Null counts as empty.
    """
    import pyarrow.compute as pc

    coder = encoder(path)
    for batch in batches:
        upto = np.cumsum(pc.fill_null(pc.binary_length(batch.column(text)), 0).to_numpy(zero_copy_only=False), dtype=np.int64)
        start = 0
        while start < batch.num_rows:
            done = int(upto[start - 1]) if start else 0
            stop = min(batch.num_rows, max(start + 1, int(np.searchsorted(upto, done + size, "right"))))
            part = batch.slice(start, stop - start)
            yield part, *coder.encode_flat(part.column(text), end_id)
            start = stop
        del batch
    coder._forget(8)
    give_back()
