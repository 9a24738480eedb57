"""Token ids of whole texts with a tokenizer file of the tokenizers library.

Both kinds of file used here never let a token reach across the start of white
space that follows a word, so the ids of a text are those of its stretches set
side by side; the file itself is asked for this, and any other file has every text
encoded whole.  So has a text that may hold the string of one of the file's added
tokens: the library finds these in texts too, and its ids count.  Each worker keeps the ids of stretches it has met (each encoded
once by the library itself) in a table of bounded size; texts with white space
other than single blanks and line feeds go to the library whole.

A new stretch of Latin letters with signs behind is its letters and its signs side
by side, since both patterns part there.  Such letters are one word for the file's
own splitting, so the library encodes them with the file's merges and vocabulary
but a splitting at blanks alone, which takes half of the time; the longest part of
the work is else the file's pattern.  Every other stretch goes through the whole file.
"""

from __future__ import annotations

import json
import os

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex


_MARK = "<|"
#: What the fast path does not cover: a text that may hold an added token, and white space other than single blanks and line feeds between words.
_ODD = r"<\||  |\n\n| \n|\n |\A[ \n]|[ \n]\z|[\t\x0b-\r\x1c-\x1f\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]"
#: Signs that both patterns part from letters before them, and that no contraction begins with.
_SIGNS = "!\"#$%&()*+,-./:;<=>?@[\\]^_`{|}~"
#: Letters below this have been letters, composed and alike in case, in every version of Unicode.
_LATIN = "\u0250"
#: The characters that stand for bytes in byte-level vocabularies.
_BYTES = np.array([b if 33 <= b <= 126 or 161 <= b <= 172 or b >= 174 else -1 for b in range(256)], "<i4")
_BYTES[_BYTES < 0] = 256 + np.arange((_BYTES < 0).sum())


def _latin(word: str) -> bool:
    """Whether it is made of Latin letters alone."""
    return word.isalpha() and (word.isascii() or max(word) < _LATIN)


def _in_stretches(config: dict) -> bool:
    """Whether a tokenizer's file says that no token reaches into white space that follows a word.

    True for byte-level splitting with its own pattern, and for a pattern of words
    and signs that drops white space; anything else is encoded whole.
    """
    normal, pre = config.get("normalizer"), config.get("pre_tokenizer") or {}
    if normal is None and pre.get("type") == "ByteLevel":
        return bool(pre.get("use_regex")) and not pre.get("add_prefix_space")
    steps, parts = (normal or {}).get("normalizers", []), pre.get("pretokenizers", [])
    if [x["type"] for x in steps] != ["NFC", "Replace", "Lowercase"] or [x["type"] for x in parts] != ["Split", "ByteLevel"]:
        return False
    split, pattern = parts[0], parts[0]["pattern"].get("Regex", "")
    drops = split["behavior"] == "Removed" and split["invert"] and not parts[1]["use_regex"] and not parts[1]["add_prefix_space"]
    return drops and not any(c.isspace() for m in regex.finditer(pattern, "a b's 1 2 .. ,\n\ta") for c in m.group())


_KEPT: dict = {}


class Table(dict):
    """Ids by stretch, in two generations: what was not met again for a whole generation goes."""

    def __init__(self, most: int):
        super().__init__()
        self.old: dict[str, bytes] = {}
        self.most = most

    def turn(self) -> None:
        """Begin a new generation if this one is full."""
        if len(self) > self.most:
            self.old = dict(self)
            self.clear()

    def missing(self, words: set[str]) -> list[str]:
        """Those of ``words`` without ids; the others are in the young generation afterwards."""
        out, old = [], self.old
        for w in words.difference(self.keys()):
            ids = old.get(w)
            if ids is None:
                out.append(w)
            else:
                self[w] = ids
        return out


class Encoder:
    """``ids(texts)`` gives little-endian uint32 ids as bytes by text, without special tokens."""

    def __init__(self, path: str, most_kept: int = 250_000):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(path)
        #: the same, not looking for added tokens: for texts that cannot hold one, where it gives the same ids sooner
        self.bare = Tokenizer.from_file(path)
        self.bare.encode_special_tokens = True
        #: whether white space counts (byte-level) or is dropped (word ends)
        self.spaced = bool(self.library.encode(" a", add_special_tokens=False).ids != self.library.encode("a", add_special_tokens=False).ids)
        #: strings of added tokens all begin alike in the files used here; ``_ODD`` leaves out texts that hold this beginning
        self.marked = all(_MARK in t.content for t in self.library.get_added_tokens_decoder().values())
        config = json.loads(self.library.to_str())
        self.fast = self.marked and _in_stretches(config)
        #: ids of stretches; where white space counts, those after a blank as they are and those after a line feed with it
        self.kept = Table(most_kept)
        self.signs: dict[str, bytes] = {}
        #: text that keeps stretches apart in a joint call, and its id
        self.between = "\n" if self.spaced else " \x01 "
        self.gap = self._whole([self.between])[0]
        self.simple, self.edge = self._simple(config["model"]) if self.fast else (None, None)

    def _simple(self, model: dict):
        """(the file's model behind a splitting at blanks alone, whether an id begins or ends a word), or nothing for another kind of model."""
        from tokenizers import Tokenizer, pre_tokenizers

        end = model.get("end_of_word_suffix") or ""
        odd = model.get("continuing_subword_prefix") or model.get("dropout") or model.get("byte_fallback")
        if model["type"] != "BPE" or odd or bool(end) == self.spaced or not {chr(c) + end for c in _BYTES} <= model["vocab"].keys():
            return None, None
        simple = Tokenizer(self.bare.model)
        simple.pre_tokenizer = pre_tokenizers.Split(chr(_BYTES[32]), "merged_with_next" if self.spaced else "removed")
        edge = np.zeros(max(model["vocab"].values()) + 1, bool)
        edge[[i for t, i in model["vocab"].items() if (t.startswith(chr(_BYTES[32])) if self.spaced else t.endswith(end))]] = True
        return simple, edge

    def _whole(self, texts: list[str]) -> list[bytes]:
        library = self.library if not self.marked or any(_MARK in t for t in texts) else self.bare
        many = getattr(library, "encode_batch_fast", library.encode_batch)
        return [np.array(x.ids, "<u4").tobytes() for x in many(texts, add_special_tokens=False)]

    def _learn(self, words: set[str]) -> None:
        """Ids of all ``words`` into the table."""
        kept = self.kept
        kept.turn()
        new, signed = kept.missing(words), []
        if self.simple is not None:
            new, signed = self._learn_letters(new)
        if self.spaced:
            self._learn_joint([w for w in new if w[0] != "\n"], " ", "")
            self._learn_joint([w[1:] for w in new if w[0] == "\n"], "", "\n")
        else:
            self._learn_joint(new, "", "")
        for w, letters in signed:
            kept[w] = kept[letters] + self.signs[w[len(letters) :]]

    def _learn_joint(self, new: list[str], lead: str, key: str) -> None:
        """Ids of stretches by the whole file, with ``lead`` before each, under ``key`` and the stretch; a line feed there has its own id first."""
        kept, front = self.kept, self.gap if key else b""
        for i in range(0, len(new), 5_000):
            part = new[i : i + 5_000]
            ids = np.frombuffer(self._whole([self.between.join([lead + w for w in part])])[0], "<u4")
            cut = np.flatnonzero(ids == np.frombuffer(self.gap, "<u4")[0]) * 4
            if len(self.gap) != 4 or len(cut) != len(part) - 1 or any("\x01" in w for w in part):
                kept.update((key + w, front + x) for w, x in zip(part, self._whole([lead + w for w in part])))
                continue
            data, a = ids.tobytes(), 0
            for w, b in zip(part, [*cut.tolist(), len(data)]):
                kept[key + w] = front + data[a:b]
                a = b + 4

    def _learn_letters(self, new: list[str]) -> tuple[list[str], list[tuple[str, str]]]:
        """Learn the Latin letters that stretches begin with; (what the whole file has to encode, stretches that are known letters and signs)."""
        kept, rest, plain, signed = self.kept, [], [], []
        for w in new:
            if _latin(w):
                plain.append(w)
            elif _latin(letters := w.rstrip(_SIGNS)):
                signed.append((w, letters))
            else:
                rest.append(w)
        plain += kept.missing({x for _, x in signed}.difference(plain))
        if len(self.signs) > 50_000:
            self.signs.clear()
        tails = list({w[len(x) :] for w, x in signed}.difference(self.signs))
        self.signs.update(zip(tails, self._whole(tails)))
        for i in range(0, len(plain), 5_000):
            part = plain[i : i + 5_000]
            text = " ".join(["", *part] if self.spaced else part)
            text = text if self.spaced else text.lower()
            ids = self._by_blanks(text)
            edges = np.flatnonzero(self.edge[ids])
            bounds = [*edges.tolist(), len(ids)] if self.spaced else [0, *(edges + 1).tolist()]
            if len(edges) != len(part) or bounds[0] or bounds[-1] != len(ids) or not self.spaced and not all(map(_latin, text.split(" "))):
                rest += part
                continue
            data = ids.tobytes()
            for w, a, b in zip(part, bounds, bounds[1:]):
                kept[w] = data[4 * a : 4 * b]
        return rest, signed

    def _by_blanks(self, text: str) -> np.ndarray:
        coded = _BYTES[np.frombuffer(text.encode(), np.uint8)].tobytes().decode("utf-32-le")
        many = getattr(self.simple, "encode_batch_fast", self.simple.encode_batch)
        return np.array(many([coded], add_special_tokens=False)[0].ids, "<u4")

    def ids(self, texts: list[str | None]) -> list[bytes]:
        out: list[bytes] = [b""] * len(texts)
        some = np.array([i for i, t in enumerate(texts) if t], int)
        column = pa.array([texts[i] for i in some], pa.large_string())
        odd = pc.match_substring_regex(column, _ODD) if self.fast else pa.array(np.ones(len(some), bool))
        by_hand = some[odd.to_numpy(zero_copy_only=False)].tolist()
        for i, x in zip(by_hand, self._whole([texts[i] for i in by_hand])):
            out[i] = x
        column, some = column.filter(pc.invert(odd)), some[~odd.to_numpy(zero_copy_only=False)]
        if not len(column):
            return out
        if self.spaced:
            column = pc.binary_join_element_wise(pa.scalar("\n", pa.large_string()), pc.replace_substring(column, "\n", " \n"), pa.scalar("", pa.large_string()))
        else:
            column = pc.replace_substring(column, "\n", " ")
        parts = pc.split_pattern(column, " ")
        coded = parts.flatten().dictionary_encode()
        words = coded.dictionary.to_numpy(zero_copy_only=False).tolist()
        self._learn(set(words))
        # the ids of all stretches, taken in order, lie side by side in one buffer
        ids = pa.array(list(map(self.kept.__getitem__, words)), pa.large_binary()).take(coded.indices)
        _, offsets, data = ids.buffers()
        at = np.frombuffer(offsets, np.int64)[ids.offset + parts.offsets.to_numpy() - parts.offsets[0].as_py()].tolist()
        front, data = len(self.gap) if self.spaced else 0, memoryview(data or b"")
        for i, a, b in zip(some.tolist(), at, at[1:]):
            out[i] = bytes(data[a + front : b])
        return out


def encoder(path: str) -> Encoder:
    """The worker's encoder for a file, made once."""
    if path not in _KEPT:
        _KEPT[path] = Encoder(path)
    return _KEPT[path]
