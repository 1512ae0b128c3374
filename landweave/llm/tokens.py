"""Token ids by the tokenizers library.

Texts are split at spaces into pieces whose ids don't depend on their neighbours, and a bounded memo
holds the ids of pieces met before, so the library sees a word once for each worker and not once for
each place. Documents where a split could change ids are encoded whole.
"""

from __future__ import annotations

import os
import re
from array import array
from string import punctuation

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: How a vocabulary's own splitting treats spaces: "prefix" keeps a space with the word behind it,
#: "dropped" drops white space, "whole" promises nothing, so every text is encoded whole.
KINDS = {"byte_bpe_50k.json": "prefix", "word_bpe_49k.json": "dropped"}
#: Control characters that Python and the vocabularies may class differently as white space.
_CONTROL = r"[\x1c-\x1f]"
_BLANK = r"[\s\x0b\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]"
#: White space right before a space would make the two one token with "prefix".
_RUN = _CONTROL + "|" + _BLANK + " "
#: A line break beside white space or at an end isn't a token of its own with "prefix".
_BREAKS = rf"{_BLANK}\n|\n{_BLANK}|^\n|\n$"
_SLICE_BYTES = 4 << 20


def vocabulary(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


class Codec:
    """Ids of texts. path: a tokenizers JSON file; kind: see KINDS; memo: pieces in each of two generations.

    When the younger generation is full it becomes the older one, and what was in the older one goes, but
    for pieces that came back meanwhile.
    """

    def __init__(self, path: str, kind: str | None = None, memo: int = 500_000):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer
        from tokenizers.pre_tokenizers import ByteLevel

        self.kind = kind or KINDS.get(os.path.basename(path), "whole")
        self.tok = Tokenizer.from_file(path)
        self.model = self.tok.model
        # a token's name in a text (in any case: some are looked for after lower-casing) makes it go whole
        names = "|".join(re.escape(t.content) for t in self.tok.get_added_tokens_decoder().values())
        self.named = f"(?i:{names})|" if names else ""
        level = ByteLevel(add_prefix_space=False, use_regex=False)
        self.bytes = {i: level.pre_tokenize_str(chr(i))[0][0] for i in range(32, 256)}
        self.limit = memo
        self.memo: dict[str, int] = {}
        self.ids, self.ends = array("I"), array("q", [0])
        self._age()

    @property
    def size(self) -> int:
        return self.tok.get_vocab_size(with_added_tokens=True)

    def _age(self) -> None:
        self.old, self.old_ids, self.old_ends = self.memo, self.ids, self.ends
        self.memo, self.ids, self.ends = {}, array("I"), array("q", [0])

    def _made(self, key: str) -> list[int]:
        """Ids of a piece; with "prefix", one that follows no space has a \\x01 before it.

        White space, runs of letters and the marks after them are tokens of their own. Words of letters
        below U+0100 need the model alone. Marks part only from such a letter: others may end in a
        combining sign once lower-cased, which belongs to the marks.
        """
        bare = key[:1] == "\x01"
        w = key[1:] if bare else key
        spaced = self.kind == "prefix" and not bare
        if w.isalpha():
            if max(w) < "Ā":
                w = w if self.kind == "prefix" else w.lower()
                w = w if w.isascii() else w.translate(self.bytes)
                return [t.id for t in self.model.tokenize(self.bytes[32] + w if spaced else w)]
        elif (n := len(w.rstrip(punctuation))) and n < len(w) and w[n - 1].isalpha() and w[n - 1] < "Ā":
            return [*self._get(self._entry(key[: n - len(w)])), *self._get(self._entry("\x01" * (self.kind == "prefix") + w[n:]))]
        return self.tok.encode(" " + w if spaced else w, add_special_tokens=False).ids

    def _get(self, k: int) -> array:
        return self.ids[self.ends[k] : self.ends[k + 1]]

    def _new(self, key: str) -> int:
        k = self.old.get(key)
        got = self._made(key) if k is None else self.old_ids[self.old_ends[k] : self.old_ends[k + 1]]
        self.ids.extend(got)
        self.ends.append(len(self.ids))
        self.memo[key] = k = len(self.ends) - 2
        return k

    def _entry(self, key: str) -> int:
        k = self.memo.get(key)
        return self._new(key) if k is None else k

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts in a row (uint32), and how many each text has; null: none."""
        texts = pc.fill_null(texts.cast(pa.large_string()), "")
        ends = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + len(texts) + 1]
        got, at = [], 0
        while at < len(texts):
            to = max(at + 1, int(np.searchsorted(ends, ends[at] + _SLICE_BYTES, "right")) - 1)
            got.append(self._slice(texts.slice(at, to - at)))
            at = to
        if not got:
            return np.zeros(0, np.uint32), np.zeros(0, np.int64)
        return np.concatenate([x[0] for x in got]), np.concatenate([x[1] for x in got])

    def _slice(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        n, prefix = len(texts), self.kind == "prefix"
        # keys of pieces may begin with a control character, so such texts go whole as well
        odd = np.ones(n, bool) if self.kind == "whole" else pc.match_substring_regex(texts, self.named + (_RUN if prefix else _CONTROL) + r"|[\x00\x01]").to_numpy(zero_copy_only=False)
        if odd.all():
            return self._whole(texts)
        plain = pc.if_else(pa.array(odd), "", texts) if odd.any() else texts
        if prefix:
            parted = pc.replace_substring(plain, "\n", " \x01\n \x01")
            plain = pc.if_else(pc.match_substring_regex(plain, _BREAKS), plain, parted)
        else:
            plain = pc.replace_substring(plain, "\n", " ")
        parts = pc.split_pattern(plain, " ")
        starts = np.asarray(parts.offsets)[: n + 1].astype(np.int64)
        starts -= starts[0]
        coded = parts.flatten().dictionary_encode()
        words, index = coded.dictionary.to_numpy(zero_copy_only=False), coded.indices.to_numpy()
        if len(self.ends) + len(words) > self.limit:
            self._age()
        found = list(map(self.memo.get, words))
        entry = np.array([self._entry(w) if k is None else k for w, k in zip(words, found, strict=True)], np.int64)[index]
        if prefix:
            entry[starts[:-1]] = [self._entry("\x01" + words[k]) for k in index[starts[:-1]]]
        ids, ends = np.frombuffer(self.ids, np.uint32), np.frombuffer(self.ends, np.int64)
        begin = ends[entry]
        count = ends[entry + 1] - begin
        total = np.cumsum(count)
        place = np.repeat((begin - (total - count)).astype(np.int32), count)
        place += np.arange(total[-1], dtype=np.int32)
        out = ids[place]
        counts = np.add.reduceat(count, starts[:-1])
        del ids, ends
        if not odd.any():
            return out, counts
        counts[odd] = 0
        more, each = self._whole(texts.filter(pa.array(odd)))
        at = np.cumsum(counts) - counts
        where = np.repeat(at[odd], each)
        counts[odd] = each
        return np.insert(out, where, more), counts

    def _whole(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        got = [x.ids for x in self.tok.encode_batch(texts.to_pylist(), add_special_tokens=False)]
        return np.fromiter((i for x in got for i in x), np.uint32), np.fromiter(map(len, got), np.int64, len(got))


_codecs: dict[str, Codec] = {}


def codec(path: str) -> Codec:
    """This worker's codec for the file at path."""
    if path not in _codecs:
        _codecs[path] = Codec(path)
    return _codecs[path]
