"""Byte-pair encoding as a streaming transducer, and decoding as a byte-to-text state machine."""

from __future__ import annotations

import json
import re
import unicodedata
from array import array
from collections.abc import Iterable, Iterator
from contextlib import suppress
from functools import lru_cache

import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Words kept with their ids in a Python worker, and as many that were met before these.
CACHE_WORDS = 150_000
_WINDOW = 256


def byte_letters() -> dict[int, str]:
    """Byte to letter: printable Latin-1 stays, the other bytes follow from U+0100 on (byte-level BPE convention)."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    other = (b for b in range(256) if b not in set(plain))
    return {b: chr(b) for b in plain} | {b: chr(0x100 + i) for i, b in enumerate(other)}


#: Planes 4 to 13 hold no assigned code point in any version, 15 and 16 are private in all.
_PLANES = [*range(0, 0xD800, 0x800), *range(0xE000, 0x40000, 0x800), 0xE0000]


class Alphabet:
    """Where the library's Unicode tables differ from those of ``regex`` and of Python, asked from the library itself.

    ``differs`` finds a code point of another class or another lower case (None if there is none), ``lower`` maps these
    to the library's lower case, ``classes`` holds the library's ranges of ``\\p{L}``, ``\\p{N}`` and ``\\s``.
    """

    def __init__(self):
        from tokenizers import Regex, normalizers, pre_tokenizers

        self.nfc = normalizers.NFC().normalize_str
        self.classes, odd = {}, set()
        for name in (r"\p{L}", r"\p{N}", r"\s"):
            theirs = pre_tokenizers.Split(Regex(f"{name}+"), "removed", invert=True)
            ours, found = regex.compile(f"{name}+"), []
            for start in _PLANES:
                block = "".join(map(chr, range(start, start + 0x800)))
                runs = [span for _, span in theirs.pre_tokenize_str(block)]
                mine = [m.span() for m in ours.finditer(block)]
                if runs != mine:
                    odd.update(*[range(start + a, start + b) for a, b in set(runs) ^ set(mine)])
                found += [(start + a, start + b) for a, b in runs]
            self.classes[name] = _ranges(found)
        lower = normalizers.Lowercase().normalize_str
        self.lower = {}
        for start in _PLANES:
            block = list(map(chr, range(start, start + 0x800)))
            for char, small in zip(block, lower("\0".join(block)).split("\0") if start else map(str.lower, block)):
                if char.lower() != small:
                    self.lower[ord(char)] = small
        odd |= set(self.lower)
        self.differs = re.compile(f"[{_ranges((c, c + 1) for c in sorted(odd))}]") if odd else None


_ASCII = {r"\p{L}": "A-Za-z", r"\p{N}": "0-9", r"\s": r"\t-\r "}


def _spelled(pattern: str, classes: dict[str, str]) -> str:
    """The pattern with the classes written as ranges."""
    out, inside, at = [], False, 0
    while at < len(pattern):
        name = next((c for c in [*classes, r"\S"] if pattern.startswith(c, at)), "")
        if name:
            ranges = classes[name.lower() if name == r"\S" else name]
            if inside and name == r"\S":
                raise ValueError("a negated class within brackets")
            out.append(ranges if inside else f"[^{ranges}]" if name == r"\S" else f"[{ranges}]")
        else:
            name = pattern[at:at + 2] if pattern[at] == "\\" else pattern[at]
            inside = name == "[" or (inside and name != "]")
            out.append(name)
        at += len(name)
    return "".join(out)


def _ranges(spans: Iterable[tuple[int, int]]) -> str:
    """Spans in rising order as the inside of a bracket, neighbours joined."""
    joined: list[list[int]] = []
    for a, b in spans:
        if joined and joined[-1][1] == a:
            joined[-1][1] = b
        else:
            joined.append([a, b])
    return "".join(f"\\U{a:08x}-\\U{b - 1:08x}" for a, b in joined)


@lru_cache(maxsize=1)
def alphabet() -> Alphabet:
    return Alphabet()


class Vocabulary:
    """The merge list of a tokenizers JSON file (BPE model), with what the transducer needs to know of it."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        model = spec["model"]
        self.ids: dict[str, int] = model["vocab"]
        self.end = model.get("end_of_word_suffix") or ""
        pairs = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in model["merges"]]
        self.rank = {p: i for i, p in reversed(list(enumerate(pairs)))}
        self.special = {t["content"]: t["id"] for t in spec.get("added_tokens") or []}
        self.names = {i: t for t, i in self.ids.items()} | {i: t for t, i in self.special.items()}
        self.special_pattern = regex.compile("|".join(map(regex.escape, sorted(self.special, key=len, reverse=True)))) if self.special else None
        steps = (spec.get("normalizer") or {}).get("normalizers") or [spec.get("normalizer") or {}]
        self.nfc = any(s.get("type") == "NFC" for s in steps)
        self.lower = any(s.get("type") == "Lowercase" for s in steps)
        split = [s for s in (spec.get("pre_tokenizer") or {}).get("pretokenizers", []) if s["type"] == "Split"]
        self.pattern = split[0]["pattern"]["Regex"] if split else None
        self.split = regex.compile(self.pattern) if split else None
        self.exact = None
        #: The same pattern for ASCII texts, with the few letters and digits that these can have.
        self.plain = self.split
        if split:
            with suppress(re.error, ValueError):  # a pattern that only ``regex`` reads stays with it
                self.plain = re.compile(_spelled(self.pattern, _ASCII))
        self.letters = byte_letters()
        self.bytes = {c: b for b, c in self.letters.items()}
        #: Bytes of a token (None: special), whether it ends a word, its text if the bytes are whole characters. Filled by ``text``.
        self.pieces: dict[int, tuple[bytes | None, bool, str]] = {i: (None, False, "") for i in self.special.values()}
        self.single: dict[str, bool] = {}
        self.states: dict[str, tuple[str, ...]] = {}
        self.spines: dict[tuple[str, int], list[tuple[str, int]] | None] = {}
        self.fits: dict[tuple[str, str], bool] = {}
        #: Sufficient lookahead in symbols: a boundary that is final lies within one longest token of the last symbol read.
        self.lookahead = 0
        #: What a token can end with, and whether it is a token itself (None: not yet known to be one that merges
        #: give). A sequence that is no key starts no token when read backwards.
        self.tails: dict[str, bool | None] = {}
        for token in self.ids:
            symbols, tail = self.symbols_of(token), ""
            self.lookahead = max(self.lookahead, len(symbols))
            for symbol in reversed(symbols):
                tail = symbol + tail
                self.tails[tail] = None if tail in self.ids else False
        self.table = {b: c for b, c in self.letters.items() if chr(b) != c}

    def symbols_of(self, token: str) -> list[str]:
        if self.end and token.endswith(self.end) and token != self.end:
            head = token[: -len(self.end)]
            return [*head[:-1], head[-1] + self.end]
        return list(token)

    def merged(self, symbols: list[str]) -> list[str]:
        """The tokens of a short symbol sequence, merge by merge in the order of the list."""
        parts = list(symbols)
        while len(parts) > 1:
            best = min(range(len(parts) - 1), key=lambda i: self.rank.get((parts[i], parts[i + 1]), len(self.rank)))
            pair = (parts[best], parts[best + 1])
            if pair not in self.rank:
                break
            out, i = [], 0
            while i < len(parts):
                if i + 1 < len(parts) and (parts[i], parts[i + 1]) == pair:
                    out.append(parts[i] + parts[i + 1])
                    i += 2
                else:
                    out.append(parts[i])
                    i += 1
            parts = out
        return parts

    def reachable(self, token: str) -> bool:
        """Whether the merges of its own symbols give the token back."""
        known = self.single.get(token)
        if known is None:
            known = self.single[token] = self.merged(self.symbols_of(token)) == [token]
        return known

    def compatible(self, left: str, right: str) -> bool:
        """Whether the two tokens stay as they are beside each other; a sequence is final if all its neighbours are."""
        known = self.fits.get((left, right))
        if known is None:
            if len(self.fits) > 4 * CACHE_WORDS:
                self.fits.clear()
            known = self._apart(self.spine(left, 1), self.spine(right, 0))
            if known is None:
                known = self.merged(self.symbols_of(left) + self.symbols_of(right)) == [left, right]
            self.fits[left, right] = known
        return known

    def spine(self, token: str, side: int) -> list[tuple[str, int]] | None:
        """The token and, part by part, what lies at its left (0) or right (1) end, each with the rank of its last merge.

        None if these ranks do not fall, or if merges do not give the token back: then the merges have to be made.
        """
        key = (token, side)
        if key not in self.spines:
            found, symbols = [], self.symbols_of(token)
            while found is not None and len(symbols) > 1:
                pair = self.last_merge(symbols)
                rank = self.rank.get(pair, -1) if pair else -1
                if rank < 0 or (found and rank >= found[-1][1]):
                    found = None
                    break
                found.append((pair[0] + pair[1], rank))
                width = len(self.symbols_of(pair[1]))
                symbols = symbols[-width:] if side else symbols[:-width]
            if found is not None:
                found.append((symbols[0], -1))
            self.spines[key] = found
        return self.spines[key]

    def last_merge(self, symbols: list[str]) -> tuple[str, str] | None:
        """The pair merged last where all symbols become one token."""
        parts = list(symbols)
        while len(parts) > 2:
            best = min(range(len(parts) - 1), key=lambda i: self.rank.get((parts[i], parts[i + 1]), len(self.rank)))
            if (parts[best], parts[best + 1]) not in self.rank:
                return None
            parts[best:best + 2] = [parts[best] + parts[best + 1]]
        return parts[0], parts[1]

    def _apart(self, left: list[tuple[str, int]] | None, right: list[tuple[str, int]] | None) -> bool | None:
        """Whether no merge crosses the border, going back in time along both spines; None where ranks leave it open.

        Two parts that lie at the border at the same time merge if their pair comes before the merge that takes either
        of them away; of equal pairs the left one comes first.
        """
        if left is None or right is None:
            return None
        i = j = 0
        never = len(self.rank)
        until_left = until_right = never
        while True:
            (a, born_a), (b, born_b) = left[i], right[j]
            rank = self.rank.get((a, b), never)
            if rank < never and rank <= max(born_a, born_b):
                return None
            if rank < until_left and rank <= until_right and rank < never:
                return False
            if born_a < 0 and born_b < 0:
                return True
            if born_a > born_b:
                until_left, i = born_a, i + 1
            else:
                until_right, j = born_b, j + 1

    def stream(self, symbols: Iterable[str]) -> Iterator[str]:
        """Tokens of a symbol stream, each as soon as no later symbol can change it.

        For every prefix the last token of its encoding is unique: the one that ends there and is compatible with the
        last token of what precedes it. Later tokens start at one of the last ``lookahead`` ends, so what the chains
        behind these ends have in common is stable, is emitted, and is forgotten.
        """
        held: list[str] = []      # symbols that are not forgotten
        last: list[str] = []      # last token of the prefix up to and with held[i]
        size: list[int] = []      # its length in symbols
        before = ""               # last token emitted
        reach = self.lookahead
        for symbol in symbols:
            self._step(symbol, held, last, size, before)
            n = len(held)
            if n >= _WINDOW + reach and n % _WINDOW == 0:
                live = {i for i in range(n - reach, n) if last[i]}
                while len(live) > 1:
                    far = max(live)
                    live.discard(far)
                    live.add(far - size[far])
                cut = live.pop() + 1 if live else 0
                if cut > 0:
                    done, at = [], cut - 1
                    while at >= 0:
                        done.append(last[at])
                        at -= size[at]
                    yield from reversed(done)
                    before = last[cut - 1]
                    held, last, size = held[cut:], last[cut:], size[cut:]
        yield from self._chain(last, size)

    def short(self, word: str) -> tuple[str, ...]:
        """As :meth:`stream` for a word within the window, of which nothing has to be forgotten.

        As the whole word is at hand, it is read from its end: only those beginnings are looked at that a token may follow.
        Their tokens depend on them alone, and many words share them.
        """
        text = word if word.isascii() and word.isprintable() else word.encode().decode("latin-1").translate(self.table)
        if len(self.states) >= CACHE_WORDS:
            self.states.clear()
        found = self._ended(text + self.end, len(text))
        if not found:
            raise ValueError("the vocabulary lacks a symbol of this text")
        return found

    def _ended(self, text: str, size: int) -> tuple[str, ...]:
        """Tokens of a text of ``size`` symbols; none if no encoding ends there.

        The last one is unique, see :meth:`stream`, so the candidates may come in any order; the longest is most often it.
        """
        tails, states, fits, ends, i = self.tails, self.states, self.fits, [], size
        while i:
            i -= 1
            token = text[i:]
            whole = tails.get(token, -1)
            if whole == -1:
                break
            if whole is None:
                whole = tails[token] = self.reachable(token)
            if whole:
                ends.append((i, token))
        for i, token in reversed(ends):
            if not i:
                return (token,)
            before = text[:i]
            left = states.get(before)
            if left is None:
                left = states[before] = self._ended(before, i)
            if left:
                fit = fits.get((left[-1], token))
                if fit is None:
                    fit = self.compatible(left[-1], token)
                if fit:
                    return *left, token
        return ()

    def _step(self, symbol: str, held: list[str], last: list[str], size: list[int], before: str) -> None:
        """Read one symbol: the last token of the prefix that ends with it, and its length ("" and 0: no encoding ends here)."""
        held.append(symbol)
        i = n = len(held)
        tails, fits, token = self.tails, self.fits, ""
        while i:
            i -= 1
            token = held[i] + token
            whole = tails.get(token, -1)
            if whole == -1:
                break
            if whole is None:
                whole = tails[token] = self.reachable(token)
            if not whole:
                continue
            left = last[i - 1] if i else before
            if left:
                fit = fits.get((left, token))
                if fit is None:
                    fit = self.compatible(left, token)
                if not fit:
                    continue
            elif i:
                continue
            last.append(token)
            size.append(n - i)
            return
        last.append("")
        size.append(0)

    def _chain(self, last: list[str], size: list[int]) -> list[str]:
        """The tokens from the last one back, in their order."""
        out, at = [], len(last) - 1
        while at >= 0:
            if not size[at]:
                raise ValueError("the vocabulary lacks a symbol of this text")
            out.append(last[at])
            at -= size[at]
        out.reverse()
        return out

    def symbols(self, word: str) -> Iterator[str]:
        """Byte letters of a word, the last with the end-of-word mark."""
        data = word.encode()
        for b in data[:-1]:
            yield self.letters[b]
        yield self.letters[data[-1]] + self.end

    def words(self, text: str) -> list[str]:
        """Normalized text in the pieces within which merges happen."""
        split = self.split
        if text.isascii():
            split = self.plain
        else:
            known = alphabet()
            if self.nfc and not unicodedata.is_normalized("NFC", text):
                text = known.nfc(text)
            if known.differs and known.differs.search(text):
                if split:
                    split = self.exact = self.exact or regex.compile(_spelled(self.pattern, known.classes))
                if self.lower:
                    return self._cut(split, "".join([known.lower.get(ord(c)) or ("σ" if c == "Σ" else c.lower()) for c in text]))
        if self.lower:  # by character: a final sigma is not treated in a way of its own
            text = (text.replace("Σ", "σ") if "Σ" in text else text).lower()
        return self._cut(split, text)

    def _cut(self, split: regex.Pattern | None, text: str) -> list[str]:
        return split.findall(text) if split else [text] if text else []

    def encode(self, text: str) -> Iterator[int]:
        """Ids of a text, special tokens in it included."""
        for part, special in self.parts(text):
            if special is not None:
                yield special
            else:
                for word in self.words(part):
                    for token in self.stream(self.symbols(word)):
                        yield self.ids[token]

    def parts(self, text: str) -> Iterator[tuple[str, int | None]]:
        at = 0
        if self.special_pattern and any(s in text for s in self.special):
            for m in self.special_pattern.finditer(text):
                yield text[at:m.start()], None
                yield m[0], self.special[m[0]]
                at = m.end()
        yield text[at:], None

    def decode(self, ids: Iterable[int]) -> str:
        """The names of the tokens joined by one space; what the library gives for files without a decoder."""
        return " ".join([name for name in map(self.names.get, ids) if name is not None])

    def text(self, ids: Iterable[int]) -> Iterator[str]:
        """Pieces of readable text: bytes go through :class:`Utf8`, an end-of-word mark becomes a space."""
        machine, pieces = Utf8(), self.pieces
        for i in ids:
            if not machine.held and i in pieces and pieces[i][2]:
                yield pieces[i][2]  # the first state reads whole characters and comes back to itself
                continue
            if i not in pieces:
                name = self.names[i]
                ended = bool(self.end) and name.endswith(self.end)
                data = bytes(self.bytes[c] for c in (name[: -len(self.end)] if ended else name))
                plain = ""
                with suppress(UnicodeDecodeError):
                    plain = data.decode() + " " * ended
                pieces[i] = data, ended, plain
            data, ended, _ = pieces[i]
            if data is None:
                yield machine.flush() + self.names[i]
            else:
                yield machine.feed(data) + (machine.flush() + " " if ended else "")
        yield machine.flush()


    def readable(self, ids: list[int]) -> str:
        """:meth:`text` of some ids in one piece."""
        try:
            found = [self.pieces[i][2] for i in ids]
        except KeyError:
            found = [""]
        return "".join(found) if all(found) else "".join(self.text(ids))


class Utf8:
    """Incremental bytes to text. State: the bytes of an unfinished character and how many are to come.

    A byte that cannot continue the character makes what is held a U+FFFD, and is read again as a start.
    """

    def __init__(self):
        self.held, self.missing, self.low, self.high = b"", 0, 0x80, 0xBF

    def feed(self, data: bytes) -> str:
        if not self.held and data.isascii():
            return data.decode()
        out = []
        for b in data:
            if self.missing and self.low <= b <= self.high:
                self.held += bytes([b])
                self.missing -= 1
                self.low, self.high = 0x80, 0xBF
                if not self.missing:
                    out.append(self.held.decode())
                    self.held = b""
                continue
            if self.missing:
                out.append(self.flush())
            if b < 0x80:
                out.append(chr(b))
            elif 0xC2 <= b <= 0xF4:
                self.held, self.missing = bytes([b]), 1 + (b >= 0xE0) + (b >= 0xF0)
                self.low = {0xE0: 0xA0, 0xF0: 0x90}.get(b, 0x80)
                self.high = {0xED: 0x9F, 0xF4: 0x8F}.get(b, 0xBF)
            else:
                out.append("�")
        return "".join(out)

    def flush(self) -> str:
        if not self.held:
            return ""
        self.__init__()
        return "�"


@lru_cache(maxsize=4)
def vocabulary(path: str) -> Vocabulary:
    return Vocabulary(path)


class _Words(dict):
    """Word to its ids as text, and what decoding these ids gives: token names, readable text.

    A word is whole characters, so the byte-to-text machine is in its first state wherever a word starts. Bounded, see
    CACHE_WORDS: when it is full its words become the older ones, and the older ones that were not asked for again are
    forgotten. Long words are not kept.
    """

    def __init__(self, vocabulary: Vocabulary, readable: bool):
        super().__init__()
        self.of, self.readable, self.older = vocabulary, readable, {}

    def __missing__(self, word: str) -> tuple[str, str, int, str]:
        value = self.older.get(word)
        brief = len(word) <= 32
        if value is None:
            tokens = self.of.short(word) if brief else self.of.stream(self.of.symbols(word))
            ids = [*map(self.of.ids.__getitem__, tokens)] if brief else array("l", map(self.of.ids.__getitem__, tokens))
            value = (" ".join(map(str, ids)), self.of.decode(ids), len(ids), self.of.readable(ids) if self.readable else "")
        if brief:
            if len(self) >= CACHE_WORDS:
                self.older = dict(self)
                self.clear()
            self[word] = value
        return value


@lru_cache(maxsize=4)
def _words(path: str, readable: bool) -> _Words:
    return _Words(vocabulary(path), readable)


def encode(docs: DataFrame, path: str, readable: bool = False) -> DataFrame:
    """``doc_id``, ``n_tokens``, ``ids`` (decimal, joined by spaces) and ``decoded`` per row of ``docs``.

    ``decoded`` is what the library's decode gives. ``readable`` adds ``text``: the ids through the byte-to-text
    machine, a space after each word. Beside the row itself a task holds the window of undecided symbols and the
    bounded table of words.

    ``path`` is a tokenizers JSON file that every executor has. A null text is an empty one: no tokens, two empty
    strings. Ids are those of the tokenizers library without special tokens added; special tokens written out in a
    text get their ids, as there. Other columns are left behind; an empty table gives no rows.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocab, known = vocabulary(path), _words(path, readable)
        for batch in batches:
            for at in range(0, batch.num_rows, 500):  # small results: ids take more room than text
                part = batch.slice(at, 500)
                counts, ids, decoded, plain = [], [], [], []
                for text in part.column(1).to_pylist():
                    got = []
                    for piece, special in vocab.parts(text or ""):
                        if special is not None:
                            got.append((str(special), vocab.names[special], 1, vocab.names[special]))
                        else:
                            got += [known[w] for w in vocab.words(piece)]
                    own = [*zip(*got)] or [(), (), (), ()]
                    ids.append(" ".join(own[0]))
                    decoded.append(" ".join(own[1]))
                    counts.append(sum(own[2]))
                    if readable:
                        plain.append("".join(own[3]))
                columns = [part.column(0), pa.array(counts, pa.int64()), pa.array(ids, pa.string()), pa.array(decoded, pa.string())]
                yield pa.RecordBatch.from_arrays(columns + [pa.array(plain, pa.string())] * readable, names)

    names = ["doc_id", "n_tokens", "ids", "decoded"] + ["text"] * readable
    rows = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    return rows.mapInArrow(run, "doc_id long, n_tokens long, ids string, decoded string" + ", text string" * readable)
