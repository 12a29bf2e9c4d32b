"""SentencePiece encoding and decoding for merge-type vocabularies (operator 5).

A text's characters start as symbols; the agenda holds the adjacent pairs
whose join is a piece, best score first and leftmost among equals, until no
pair is left.  Characters without a piece fall back to their bytes.

No merge can cross a place where the vocabulary has no piece over the two
characters that meet there.  Texts are cut at such places, read off the
vocabulary: into words before each run of spaces, and these around
characters that occur in no longer piece and between a letter and marks
that no piece has behind a letter.  Words and their parts repeat a lot, so
each task keeps bounded tables of those it has worked out.  The agendas of
an Arrow batch's new parts are worked off together, one merge of every part
at a time, as arrays.  In every batch the parts that are new are checked against the sentencepiece library,
ids and decoded text, and so is every whole text that has a cut between two
characters which no text before had one between; a difference raises.
"""

from __future__ import annotations

import codecs
import re
from collections.abc import Iterable, Iterator
from heapq import heapify, heappop, heappush
from itertools import chain, filterfalse

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerloom.llm.common import column_of, text_slices

MARK = "▁"
#: Words, and parts of words, that a task remembers; beyond it a table starts anew.
REMEMBERED = 600_000
#: Parts whose agendas are worked off together, and the longest of them in characters.
AT_ONCE, SHORT = 2_000, 48
_NONE = np.iinfo(np.int32).max
_SPACED = re.compile(" *[^ ]+| +")


def _each_byte(error: UnicodeDecodeError) -> tuple[str, int]:
    return "�" * (error.end - error.start), error.end


class PieceModel:
    """A merge-type vocabulary, read from the library's model file as bytes."""

    def __init__(self, model: bytes):
        import sentencepiece

        codecs.register_error("each_byte", _each_byte)
        self.library = sp = sentencepiece.SentencePieceProcessor(model_proto=model)
        ids = range(sp.get_piece_size())
        self.end_id = sp.eos_id()
        odd = [sp.is_control(i) or sp.is_unknown(i) or sp.is_byte(i) for i in ids]
        self.id_of = {sp.id_to_piece(i): i for i in ids if not odd[i]}
        self.cost = {p: -sp.get_score(i) for p, i in self.id_of.items() if not sp.is_unused(i)}
        self.byte_ids = [sp.piece_to_id(f"<0x{b:02X}>") for b in range(256)]
        self.unknown = sp.unk_id()
        self.has_bytes = sp.is_byte(self.byte_ids[0])
        value = {i: b for b, i in enumerate(self.byte_ids)} if self.has_bytes else {}
        self.high = {i for i, b in value.items() if b > 127}
        self.bytes_of = [bytes([value[i]]) if i in value else b"" if sp.is_control(i) else " ⁇ ".encode() if sp.is_unknown(i)
                         else sp.id_to_piece(i).replace(MARK, " ").encode() for i in ids]
        self.marked = {i for p, i in self.id_of.items() if p[0] == MARK}
        self.text_of = [b.decode("utf-8", "replace") for b in self.bytes_of]
        self.cut = self._cuts()
        self._pairs()

    def _pairs(self) -> None:
        """Numbers for symbols, cheapest piece first, and the sorted pairs of
        symbols whose join is a piece, each with the join's number."""
        pieces = sorted(self.cost, key=self.cost.get)
        symbols = list(dict.fromkeys([*pieces, *"".join(pieces)]))
        number = {s: i for i, s in enumerate(symbols)}
        self.n_symbols = len(symbols)
        joins = [p for p in pieces if len(p) > 1]
        # numbers don't stand for costs where joins cost the same; such a join needs two of these characters side by side
        cost = [self.cost[p] for p in joins]
        tied = set("".join(p for p, c, a, b in zip(joins, cost, [None, *cost], [*cost[1:], None]) if c in (a, b)))
        self.tied = np.array([s in tied for s in symbols])
        found = [(a * self.n_symbols + b, number[p]) for p in joins for i in range(1, len(p))
                 if (a := number.get(p[:i])) is not None and (b := number.get(p[i:])) is not None]
        found.sort()
        self.pair = np.array([*(k for k, _ in found), np.iinfo(np.int64).max])
        self.join = np.array([*(j for _, j in found), _NONE], np.int32)
        self.symbol_of = np.full(0x110000, -1, np.int32)  # by code point
        for s, i in number.items():
            if len(s) == 1:
                self.symbol_of[ord(s)] = i
        self.symbol_id = np.array([self.id_of.get(s, -1) for s in symbols], np.int32)

    def _joins(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Numbers of the joins of symbols; none where it is no piece, or where one of the two is -1."""
        key = np.where((a < 0) | (b < 0), -1, a.astype(np.int64) * self.n_symbols + b)
        at = np.searchsorted(self.pair, key)
        return np.where(self.pair[at] == key, self.join[at], _NONE)

    def merge_all(self, parts: list[str]) -> list[bytes]:
        """``merge`` of every part, as the bytes of int32 ids.  A row holds a
        part's symbols and one the numbers of its adjacent joins: the smallest,
        leftmost among equals, is merged in all rows that have one, and those
        are then one symbol shorter."""
        out, order = [b""] * len(parts), sorted(range(len(parts)), key=list(map(len, parts)).__getitem__)
        for n in range(0, len(parts), AT_ONCE):  # parts of about one length
            some = order[n : n + AT_ONCE]
            for i, ids in zip(some, self._merge_rows([parts[i] for i in some])):
                out[i] = ids
        return out

    def _merge_rows(self, parts: list[str]) -> list[bytes]:
        size = np.fromiter(map(len, parts), np.int64, len(parts))
        fits = size <= SHORT
        size[~fits] = 0
        width = int(size.max(initial=0))
        codes = np.frombuffer("".join(p for p, f in zip(parts, fits) if f).encode("utf-32-le"), "<u4")
        symbols = np.full((len(parts), width + 1), -1, np.int32)
        inside = np.arange(width + 1) < size[:, None]
        symbols[inside] = self.symbol_of[codes]
        tied = self.tied[symbols] & inside
        # characters of no piece go their own way, and so does what may have joins of one cost
        fits &= ~((symbols < 0) & inside).any(axis=1) & ~(tied[:, :-1] & tied[:, 1:]).any(axis=1)
        ended, row = symbols.copy(), np.flatnonzero(fits)
        symbols = symbols[row]
        joins = self._joins(symbols[:, :-1], symbols[:, 1:])
        while len(row) and joins.shape[1]:
            at = joins.argmin(axis=1)
            join = joins[np.arange(len(row)), at]
            live = join != _NONE
            if not live.all():
                done = symbols[~live]
                ended[row[~live]] = -1
                ended[row[~live], : done.shape[1]] = done
                row, symbols, joins, at, join = row[live], symbols[live], joins[live], at[live], join[live]
            each, column = np.arange(len(row)), np.arange(joins.shape[1])
            symbols = np.take_along_axis(symbols, column + (column > at[:, None]), axis=1)
            symbols[each, at] = join
            column = column[:-1]
            joins = np.take_along_axis(joins, column + (column >= at[:, None]), axis=1)
            for shift in (0, 1):  # the new symbol's joins with the one behind it and the one before it
                some = (at >= shift) & (at - shift < joins.shape[1])
                r, c = each[some], at[some] - shift
                joins[r, c] = self._joins(symbols[r, c], symbols[r, c + 1])
        if len(row):
            ended[row] = -1
            ended[row, : symbols.shape[1]] = symbols
        ids = self.symbol_id[ended]
        fits &= ~((ids < 0) & (ended >= 0)).any(axis=1)  # neither do symbols without an id
        held = (ended >= 0) & fits[:, None]
        ends = 4 * np.cumsum(held.sum(axis=1))
        flat = ids[held].tobytes()
        return [flat[a:b] if f else np.array(self.merge(p), np.int32).tobytes()
                for p, f, a, b in zip(parts, fits.tolist(), [0, *ends[:-1].tolist()], ends.tolist())]

    def _cuts(self) -> re.Pattern | None:
        """Where a word may be cut; None if pieces run across words."""
        self.uncut = False
        longer = [p for p in self.cost if len(p) > 1]
        inside = set("".join(longer))
        ascii_ = [chr(c) for c in range(1, 128)]
        self.apart = next((c for c in ascii_ if c not in inside and c != " "), None)
        if any(b == MARK and a != MARK for p in longer for a, b in zip(p, p[1:])):
            return None
        letters = "A-Za-zÀ-ÖØ-öø-ɏͰ-῿"
        letter = re.compile(f"[{letters}]")
        behind = {b for p in longer for a, b in zip(p, p[1:]) if letter.match(a)}
        single = "".join(re.escape(c) for c in ascii_ if c not in inside and c != " ")
        opens = "".join(re.escape(c) for c in ascii_ if c in inside and not letter.match(c) and c not in behind)
        word = f"{MARK}*[{letters}]+(?=[{opens}])|" if opens else ""
        alone = f"|[{single}]" if single else ""
        self.uncut = not letter.search(single)
        return re.compile(f"{word}{MARK}*[^{MARK}{single}]+|{MARK}+{alone}")

    def merge(self, part: str) -> list[int]:
        """Ids of a part, by the agenda of adjacent pairs.  A short part's
        agenda is a list of its pairs' costs, a long one's is a heap."""
        symbol = self._merge_long(part) if len(part) > 48 else self._merge_short(part)
        out = []
        for s in symbol:
            if s:
                if (i := self.id_of.get(s)) is not None:
                    out.append(i)
                elif self.has_bytes:
                    out += [self.byte_ids[b] for b in s.encode()]
                else:
                    out.append(self.unknown)
        return out

    def _merge_short(self, part: str) -> list[str]:
        cost, symbol, none = self.cost.get, list(part), float("inf")
        agenda = [cost(a + b, none) for a, b in zip(symbol, symbol[1:])]
        while agenda and (best := min(agenda)) != none:
            i = agenda.index(best)
            symbol[i] += symbol.pop(i + 1)
            del agenda[i]
            if i < len(agenda):
                agenda[i] = cost(symbol[i] + symbol[i + 1], none)
            if i:
                agenda[i - 1] = cost(symbol[i - 1] + symbol[i], none)
        return symbol

    def _merge_long(self, part: str) -> list[str]:
        cost, symbol, n = self.cost, list(part), len(part)
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        agenda = [(c, i, i + 1, 2) for i in range(n - 1) if (c := cost.get(symbol[i] + symbol[i + 1])) is not None]
        heapify(agenda)
        while agenda:
            _, left, right, size = heappop(agenda)
            if not symbol[left] or not symbol[right] or len(symbol[left]) + len(symbol[right]) != size:
                continue  # one of the two has merged meanwhile
            symbol[left] += symbol[right]
            symbol[right] = ""
            after[left] = nxt = after[right]
            if nxt < n:
                before[nxt] = left
                if (c := cost.get(joined := symbol[left] + symbol[nxt])) is not None:
                    heappush(agenda, (c, left, nxt, len(joined)))
            if (prv := before[left]) >= 0 and (c := cost.get(joined := symbol[prv] + symbol[left])) is not None:
                heappush(agenda, (c, prv, left, len(joined)))
        return symbol

    def words(self, text: str) -> list[str]:
        """The text's words, each behind one space of its own; one that stands
        behind more spaces carries them all."""
        text = text.replace(MARK, " ")
        if not text:
            return []
        if self.cut is None:
            return [" " + text]
        if "  " in text or text[0] == " " or text[-1] == " ":
            return _SPACED.findall(" " + text)
        return text.split(" ")

    def parts(self, word: str) -> list[str]:
        marked = word.replace(" ", MARK) if word[:1] == " " else MARK + word
        return [marked] if self.cut is None else self.cut.findall(marked)

    def whole(self, word: str) -> bool:
        """Whether a word without spaces is one part: letters alone, none of which stands by itself."""
        return self.uncut and word.isascii() and word.isalpha()

    def encode(self, text: str) -> list[int]:
        return [i for word in self.words(text) for part in self.parts(word) for i in self.merge(part)]

    def decode(self, ids: list[int]) -> str:
        """The text of ids: marks are spaces, the first one goes, byte pieces
        are read as UTF-8 with U+FFFD for each byte that does not fit."""
        if self.high.isdisjoint(ids):
            text = "".join(map(self.text_of.__getitem__, ids))
        else:
            runs = [[]]
            for i in ids:  # bytes on either side of a control id don't make one character
                runs[-1].append(self.bytes_of[i]) if self.bytes_of[i] else runs.append([])
            text = "".join(b"".join(r).decode("utf-8", "each_byte") for r in runs)
        return text[1:] if text[:1] == " " and next((i in self.marked for i in ids if self.bytes_of[i]), False) else text

    def check(self, parts: list[str], ids: list[list[int]]) -> None:
        """Against the library: the parts' ids, and the ids' text.  A character
        that merges with nothing stands before each part where there is one,
        so that many parts make one text."""
        at_once = 256 if self.apart else 1
        lead = self.merge(self.apart) if self.apart else []
        for n in range(0, len(parts), at_once):
            some = parts[n : n + at_once]
            text = "".join((self.apart or "") + p for p in some).replace(MARK, " ")
            own = [i for x in ids[n : n + at_once] for i in (*lead, *x)]
            if self.apart:
                own = self.merge(MARK) + own
            else:
                text = text[1:]
            theirs = self.library.encode(text)
            if own != theirs or self.decode(own) != self.library.decode(theirs):
                raise ValueError(f"encoding differs from the library's among {some}")


    def check_whole(self, texts: list[tuple[str, list[int], str]]) -> None:
        """Whole texts with their ids (no end id) and decoded text, against the library."""
        for text, ids, decoded in texts:
            if self.library.encode(text) != ids or self.library.decode(ids) != decoded:
                raise ValueError(f"encoding differs from the library's for a text of {len(text)} characters that begins {text[:80]!r}")


class _Table(dict):
    """Word to ids, as the bytes of int32; new parts wait for the check, and so
    do texts in which two characters meet at a cut between words that no text
    before had there."""

    def __init__(self, model: PieceModel):
        self.model = model
        self.ids_of: dict[str, bytes] = {}
        self.new: list[str] = []
        self.met: set[tuple[str, str]] = set()
        self.whole: list[tuple[str, list[int], str]] = []

    def meets(self, words: list[str]) -> bool:
        """Whether two characters meet between these words for the first time."""
        here = set(zip([w[-1] for w in words], [w[0] for w in words[1:]])) - self.met if len(words) > 1 else not self.met and words
        if here:
            self.met |= here if isinstance(here, set) else {("", "")}
        return bool(here)

    def learn(self, words: Iterable[str]) -> None:
        """Work out ``words``, none of them known yet."""
        fresh, whole, ids_of = set(words), self.model.whole, self.ids_of
        alone = {w: MARK + w for w in fresh if whole(w)}
        cut = {w: self.model.parts(w) for w in fresh if w not in alone}
        new = list(filterfalse(ids_of.__contains__, {*alone.values(), *chain.from_iterable(cut.values())}))
        ids_of.update(zip(new, self.model.merge_all(new)))
        self.new += new
        self.update(zip(alone, map(ids_of.__getitem__, alone.values())))
        for w, of in cut.items():
            self[w] = b"".join(map(ids_of.__getitem__, of))

    def checked(self) -> None:
        self.model.check(self.new, [np.frombuffer(self.ids_of[p], np.int32).tolist() for p in self.new])
        self.model.check_whole(self.whole)
        self.new, self.whole = [], []

    def bound(self) -> None:
        if len(self) > REMEMBERED:
            self.clear()
        if len(self.ids_of) > REMEMBERED:
            self.ids_of.clear()


def encode_texts(docs: DataFrame, model_file: str, key: list[str], text: str = "text", add_end: bool = True,
                 check: bool = True) -> DataFrame:
    """``key`` columns, ``ids`` (array<int>) and ``decoded`` (the text of the
    ids) for each row; repeated rows are kept, other columns are not read.

    A null text counts as empty; an empty one has only the end id, if one is
    added.  Whole texts are encoded, of any length.  The model file is read on
    the driver (its size is fixed, about half a MB) and travels with the job."""
    with open(model_file, "rb") as f:
        model = f.read()
    frame = docs.select(*key, F.col(text).alias("__text"))
    schema = frame.drop("__text").schema.add("ids", T.ArrayType(T.IntegerType())).add("decoded", "string")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = _Table(m := PieceModel(model))
        end = np.array([m.end_id] if add_end else [], np.int32).tobytes()
        for batch in batches:
            for rows, _, _ in text_slices(batch, "__text"):
                bounds, values, texts = [0], [], []
                here = column_of(batch, "__text", rows).to_pylist()
                split = [m.words(t or "") for t in here]
                found = [list(map(known.get, words)) for words in split]
                known.learn(w for words, of in zip(split, found) for w, i in zip(words, of) if i is None)
                for t, words, of in zip(here, split, found):
                    own = np.frombuffer(b"".join([known[w] if i is None else i for w, i in zip(words, of)]) + end, np.int32)
                    values.append(own)
                    bounds.append(bounds[-1] + len(own))
                    ids = own.tolist()
                    texts.append(m.decode(ids))
                    if check and known.meets(words):
                        plain = ids[: len(ids) - len(end) // 4]
                        known.whole.append((t, plain, m.decode(plain)))
                if check:
                    known.checked()
                known.bound()
                ids = pa.ListArray.from_arrays(pa.array(bounds, pa.int32()), pa.array(np.concatenate(values)))
                yield pa.RecordBatch.from_arrays([*(column_of(batch, k, rows) for k in key), ids, pa.array(texts, pa.string())], [*key, "ids", "decoded"])

    return frame.mapInArrow(run, schema)
