"""BPE encoding and decoding as bounded-lookahead streaming transducers.

Encoding.  Merges by rank leave every prefix of a word with one encoding, and
the last token ``t`` of that encoding is the only token that ends there and
*agrees* with the last token of the prefix before it: no merge across their
border would have fired before both were complete.  The transducer therefore
keeps, per symbol read, only that last token.  A later token reaches back at
most ``max_len`` symbols, so as soon as all positions that can still be
continued lead back through one border, everything left of it is stable and is
emitted.  ``lookahead`` is the bound that follows from the merge list alone:
a change can travel left only along borders whose rules have rising ranks, so
the longest such chain times the longest token is enough; a border that has not
come by then is an error.  Memory is constant:
the symbols since the last stable border, plus memo tables of fixed size.

Decoding.  ``ByteDecoder`` takes one id at a time, turns it into bytes and
feeds an incremental UTF-8 decoder, which holds back at most three bytes of an
unfinished character.

Merge list and vocabulary are read from a tokenizer file whose path is a
parameter; nothing is copied.
"""

from __future__ import annotations

import codecs
import hashlib
import json
import os
import re
import unicodedata
from functools import lru_cache
from itertools import islice

#: Fixed values of the tokenizer format: contractions of its pre-token pattern and the white space of its normaliser.
CONTRACTIONS = "'s|'t|'re|'ve|'m|'ll|'d"
SPACE = re.compile(r"[\t\n\x0b\x0c\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]+")
#: Letters, numbers and lower-case forms of Unicode 16 (lower case: 17) that the running Python's tables may lack.
LATER_LETTERS = """1c89-1c8a a7cb-a7cd a7da-a7dc 105c0-105f3 10d4a-10d65 10d6f-10d85 10ec2-10ec4 11380-11389 1138b 1138e 11390-113b5
113b7 113d1 113d3 11bc0-11be0 13460-143fa 16100-1611d 16d40-16d6c 18cff 1e5d0-1e5ed 1e5f0"""
LATER_NUMBERS = "10d40-10d49 116d0-116e3 11bf0-11bf9 16130-16139 16d70-16d79 1ccf0-1ccf9 1e5f1-1e5fa"
LATER_LOWER = """1c89:1c8a a7cb:264 a7cc:a7cd a7ce:a7cf a7d2:a7d3 a7d4:a7d5 a7da:a7db a7dc:19b 10d50-10d65:10d70 16ea0-16eb8:16ebb"""
WORD_END = "</w>"
#: Entries after which a memo table starts afresh; the one before is kept beside it.
MEMO = 200_000
#: Symbols of a word's beginning whose state is kept.
HEAD = 6
NEVER = 1 << 60


def byte_alphabet() -> dict[int, str]:
    """The byte-level alphabet: printable Latin-1 bytes stand for themselves,
    the others are numbered from 256 on in order."""
    plain = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b]
    out = {b: chr(b) for b in plain}
    for k, b in enumerate(b for b in range(256) if b not in out):
        out[b] = chr(256 + k)
    return out


def spans(text: str) -> list[range]:
    """The code points of a list of hexadecimal ranges."""
    ends = [part.split("-") for part in text.split()]
    return [range(int(e[0], 16), int(e[-1], 16) + 1) for e in ends]


def pretoken(ascii_only: bool = False) -> re.Pattern:
    """Contractions, runs of letters, single numbers, runs of anything else, over
    stretches without white space."""
    top = 0x80 if ascii_only else 0x110000
    sets: dict[str, set] = {"L": {c for r in spans(LATER_LETTERS) for c in r if c < top}, "N": {c for r in spans(LATER_NUMBERS) for c in r if c < top}}
    for c in range(top):
        if (kind := unicodedata.category(chr(c))[0]) in sets:
            sets[kind].add(c)
    letter, number = (_ranges(sorted(sets[k])) for k in "LN")
    return re.compile(f"{CONTRACTIONS}|[{letter}]+|[{number}]|[^{letter}{number}]+")


def _ranges(codes: list[int]) -> str:
    out: list[list[int]] = []
    for c in codes:
        if out and c == out[-1][1] + 1:
            out[-1][1] = c
        else:
            out.append([c, c])
    return "".join(f"\\U{a:08x}-\\U{b:08x}" for a, b in out)


def later_lower() -> dict[int, int]:
    """Capital -> small letter, for capitals that lower() may not know."""
    out = {}
    for pair in LATER_LOWER.split():
        own, to = pair.split(":")
        for r in spans(own):
            out |= {c: int(to, 16) + k for k, c in enumerate(r)}
    return out


#: Character of the byte alphabet -> byte, and back.
CODES = {c: b for b, c in byte_alphabet().items()}
ALPHABET = byte_alphabet()


class Merges:
    """What the transducer needs of a tokenizer file with word ends."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model = spec["model"]
        self.vocab: dict[str, int] = model["vocab"]
        self.special = {t["content"]: t["id"] for t in spec.get("added_tokens", [])}
        self.strings = {i: s for s, i in self.vocab.items()} | {i: s for s, i in self.special.items()}
        self.rank: dict[tuple[str, str], int] = {}
        self.parts: dict[str, tuple[int, str, str]] = {}
        for r, pair in enumerate(model["merges"]):
            a, b = pair if isinstance(pair, list) else pair.split(" ")
            self.rank.setdefault((a, b), r)
            self.parts.setdefault(a + b, (r, a, b))
        inner = {t for t in self.vocab if not t.endswith(WORD_END)}
        final = {t.removesuffix(WORD_END) for t in self.vocab if t.endswith(WORD_END)}
        self.max_len = max(map(len, inner | final))
        # tokens by their symbols from the last to the first.  A node is
        # [nodes one symbol further left, token inside a word, its agreements, token at a word's end, its agreements]
        self.root: list = [{}, None, None, None, None]
        self._asked: list[dict] = []  # agreements: last token before -> do they stay apart
        self._answers = 0
        for at, ending, tokens in ((1, "", inner), (3, WORD_END, final)):
            for t in tokens:
                node = self.root
                for c in reversed(t):
                    node = node[0].setdefault(c, [{}, None, None, None, None])
                node[at], node[at + 1] = t + ending, {"": True}
        self._left: dict[str, list] = {}
        self._right: dict[str, list] = {}
        self.pieces: dict[int, bytes] = {}

    @property
    def lookahead(self) -> int:
        """Symbols after which a token can no longer change."""
        chain, longest = {}, 1
        for r, a, b in sorted(self.parts.values()):
            here = 1 + chain.get(b, 0)
            longest = max(longest, here)
            while True:
                chain[a] = max(chain.get(a, 0), here)
                if a not in self.parts:
                    break
                a = self.parts[a][1]
        return longest * self.max_len

    def _spine(self, token: str, side: int, memo: dict) -> list[tuple[str, int, int]]:
        """The pieces at one edge of ``token`` over time: (piece, rank at which
        it came to be, rank at which it went into a larger one)."""
        if (out := memo.get(token)) is None:
            out, until, at = [], NEVER, token
            while at in self.parts:
                r, *halves = self.parts[at]
                out.append((at, r, until))
                at, until = halves[side], r
            out.append((at, -1, until))
            memo[token] = out
        return out

    def agree(self, a: str, b: str, answers: dict) -> bool:
        """Do ``a`` and ``b`` stay apart when they stand side by side?  A rule
        that has the same rank left of the border goes first, as merging runs
        from the left.  ``answers`` (those of ``b``) takes the answer; all tables
        of answers start afresh once they hold ``MEMO`` together."""
        known = True
        for x, born, gone in self._spine(a, 1, self._right):
            for y, born_y, gone_y in self._spine(b, 0, self._left):
                q = self.rank.get((x, y))
                if q is not None and born < q < gone and born_y < q <= gone_y:
                    known = False
        if self._answers >= MEMO:
            for d in self._asked:
                d.clear()
                d[""] = True
            self._asked, self._answers = [], 0
        if len(answers) == 1:
            self._asked.append(answers)
        answers[a] = known
        self._answers += 1
        return known


class Transducer:
    """Symbols of one word in, tokens out as soon as they are stable."""

    def __init__(self, merges: Merges):
        self.m = merges
        # stable borders are looked for after so many symbols; `lookahead` is when one must have come
        self.stride = min(max(2 * merges.max_len, 256), merges.lookahead)
        self.heads: dict[str, list[str]] = {}

    def word(self, word: str):
        """Yield the tokens of ``word`` (in the byte alphabet, without word end)
        as soon as they are stable."""
        before = ""  # the token emitted last
        last: list[str] = [before]  # last[k + 1]: last token of the prefix that ends with the k-th symbol held
        base = 0  # all before it is emitted
        while base + len(last) - 1 < len(word) - 1:
            self._read(word, base, last, min(len(word) - 1, base + len(last) - 1 + self.stride))
            held = last[1:]
            stable = self._common(held) if base + len(held) < len(word) - 1 else 0
            if stable:
                out = self._back(held, stable)
                yield from out
                before = out[-1]
                last = [before, *held[stable:]]
                base += stable
            elif len(held) > self.m.lookahead + self.m.max_len:
                raise AssertionError(f"no border in {len(held)} symbols; the merge list allows {self.m.lookahead}")
        yield from self.ended(word, base, last)

    def tokens(self, word: str) -> list[str]:
        """The tokens of ``word``; a word of up to a stride's symbols is held whole."""
        if len(word) > self.stride:
            return list(self.word(word))
        if len(word) <= HEAD:
            last = [""]
        else:
            # many words begin alike: the state after the first symbols is kept
            head = word[:HEAD]
            last = self.heads.get(head)
            if last is None:
                if len(self.heads) >= MEMO:
                    self.heads.clear()
                self._read(word, 0, last := [""], HEAD)
                self.heads[head] = last
            last = last.copy()
        self._read(word, 0, last, len(word) - 1)
        return self.ended(word, 0, last)

    def _read(self, word: str, base: int, last: list[str], end: int) -> None:
        """Read the symbols after those held, up to ``end``, into ``last``."""
        agree, root = self.m.agree, self.m.root[0]
        for i in range(base + len(last) - 1, end):
            j, node = i, root.get(word[i])
            while node is not None:
                kids, t, answers, _, _ = node
                if t is not None:
                    prev = last[j - base]
                    apart = answers.get(prev)
                    if apart is None:
                        apart = agree(prev, t, answers)
                    if apart:
                        last.append(t)
                        break
                j -= 1
                node = kids.get(word[j]) if j >= base else None
            else:
                raise ValueError(f"no token ends at symbol {i} of {word[max(0, i - 40):i + 1]!r}")

    def ended(self, word: str, base: int, last: list[str]) -> list[str]:
        """The tokens held, with the one that the word's last symbol ends."""
        j = len(word) - 1
        node = self.m.root[0].get(word[j])
        while node is not None:
            kids, _, _, t, answers = node
            if t is not None:
                prev = last[j - base]
                apart = answers.get(prev)
                if apart is None:
                    apart = self.m.agree(prev, t, answers)
                if apart:
                    out, k = [t], j - base
                    while k > 0:
                        out.append(last[k])
                        k -= len(last[k])
                    return out[::-1]
            j -= 1
            node = kids.get(word[j]) if j >= base else None
        raise ValueError(f"no token ends {word[-40:]!r}")

    def _common(self, last: list[str]) -> int:
        """Length of the longest prefix of the held symbols through whose end
        every path that can still be continued runs."""
        live = {len(last) - k for k in range(min(self.m.max_len, len(last)))}
        while len(live) > 1:
            top = max(live)
            live.discard(top)
            live.add(top - len(last[top - 1]))
        return live.pop()

    @staticmethod
    def _back(last: list[str], n: int) -> list[str]:
        out = []
        while n > 0:
            out.append(last[n - 1])
            n -= len(last[n - 1])
        return out[::-1]


class Encoder:
    """Text to ids: normalise, split at special tokens and white space, run the
    transducer on every word.  White space parts words, so the memo may work on
    the stretches between it."""

    def __init__(self, path: str):
        self.merges = Merges(path)
        self.transducer = Transducer(self.merges)
        self.bytes = byte_alphabet()
        self.table = str.maketrans({b: c for b, c in self.bytes.items()})
        names = sorted(self.merges.special, key=len, reverse=True)
        self.special = re.compile("(" + "|".join(map(re.escape, names)) + ")") if names else None
        self.pretoken, self.ascii_pretoken = pretoken(), pretoken(ascii_only=True)
        self.later_lower = later_lower()
        self.later = re.compile("[" + _ranges(sorted(self.later_lower)) + "]")

    def symbols(self, word: str) -> str:
        return word if word.isascii() and word.isalnum() else word.encode("utf-8").decode("latin-1").translate(self.table)

    def word(self, word: str) -> tuple[int, ...]:
        return tuple(map(self.merges.vocab.__getitem__, self.transducer.tokens(self.symbols(word))))

    def words(self, stretch: str) -> list[str]:
        """A normalised stretch without white space, cut into words."""
        if not stretch.isascii():
            return self.pretoken.findall(stretch)
        return [stretch] if stretch.isalpha() else self.ascii_pretoken.findall(stretch)

    def stretch(self, stretch: str) -> tuple[int, ...]:
        """Ids of a normalised stretch without white space."""
        return tuple(i for w in self.words(stretch) for i in self.word(w))

    def parts(self, text: str | None):
        """The text's special ids (int) and normalised stretches (str) in order."""
        for k, piece in enumerate(self.special.split(text) if self.special and text else [text or ""]):
            if k % 2:
                yield self.merges.special[piece]
            elif piece.isascii():
                # str.split() also parts at the ASCII separators 0x1C-0x1F, which are no white space here
                low = piece.lower()
                yield from (low.split() if not any(c in low for c in "\x1c\x1d\x1e\x1f") else filter(None, SPACE.split(low)))
            elif piece:
                low = unicodedata.normalize("NFC", piece)
                if self.later.search(low):
                    low = low.translate(self.later_lower)
                low = low.replace("Σ", "σ").lower()
                yield from filter(None, SPACE.split(low))

    def encode(self, text: str | None) -> list[int]:
        out: list[int] = []
        for p in self.parts(text):
            out.extend(self.stretch(p)) if isinstance(p, str) else out.append(p)
        return out


class ByteDecoder:
    """Ids in, text out, one id at a time.  The state is an incremental UTF-8
    decoder, which holds back at most three bytes of an unfinished character.

    ``form="text"`` gives running text (a word end becomes a space);
    ``form="pieces"`` gives what a tokenizer file without a decoder does: every
    id's bytes in the byte alphabet, word ends written out, one space between
    ids.  Unknown ids add nothing.
    """

    def __init__(self, merges: Merges, form: str = "text"):
        if form not in ("text", "pieces"):
            raise ValueError(f"form is {form!r}, not text or pieces")
        self.merges, self.form = merges, form
        self.state = codecs.getincrementaldecoder("utf-8")("replace")
        self.started = False

    def bytes_of(self, i: int) -> bytes:
        """What id ``i`` adds to the byte stream."""
        if (b := self.merges.pieces.get(i)) is None:
            s = self.merges.strings.get(i, "")
            if s in self.merges.special:
                b = s.encode("utf-8")
            else:
                b = bytes(CODES[c] for c in s.removesuffix(WORD_END)) + b" " * s.endswith(WORD_END)
            self.merges.pieces[i] = b
        return b

    def piece(self, i: int) -> str:
        """The id's bytes in the byte alphabet, a word's end written out."""
        b, s = self.bytes_of(i), self.merges.strings.get(i, "")
        if s in self.merges.special:
            return b.decode("utf-8")
        ended = s.endswith(WORD_END)
        return b[:len(b) - ended].decode("latin-1").translate(ALPHABET) + WORD_END * ended

    def feed(self, i: int) -> str:
        if self.form == "pieces":
            s = self.piece(i)
            lead = " " if self.started and s else ""
            self.started = self.started or bool(s)
            return lead + s
        return self.state.decode(self.bytes_of(i))

    def feed_all(self, ids) -> str:
        """The running text of several ids at once."""
        return self.state.decode(b"".join(map(self.bytes_of, ids)))

    def finish(self) -> str:
        return self.state.decode(b"", final=True)

    def decode(self, ids) -> str:
        return "".join([*map(self.feed, ids), self.finish()])


@lru_cache(maxsize=2)
def encoder(path: str) -> Encoder:
    """One encoder per Python worker and file: the tables are built once."""
    return Encoder(path)


def tokenizer_path(name: str = "word_bpe_49k.json") -> str:
    """Place of a public tokenizer file: ``$TOKENIZERS_DIR`` or the installed package."""
    if folder := os.environ.get("TOKENIZERS_DIR"):
        return os.path.join(folder, name)
    import public_tokenizers
    return public_tokenizers.path(name)


class Digester:
    """Ids and digests of whole texts, with a memo of bounded size on stretches.

    An entry holds the ids in decimal and their decoded pieces as byte strings.
    Stretches without an entry go through the transducer, and its ids through the
    byte decoder: their running text must be the word that went in."""

    def __init__(self, path: str):
        self.enc = Encoder(path)
        self.decoder, self.pieces = ByteDecoder(self.enc.merges), ByteDecoder(self.enc.merges, "pieces")
        self.memo: dict = {}
        self.old: dict = {}
        self.said: dict[int, tuple[bytes, bytes]] = {}  # id -> its number and its piece

    def entry(self, part) -> tuple[bytes, bytes]:
        """The entry of a special id or a stretch; a stretch of several words is
        put together from theirs."""
        if isinstance(part, int):
            return self.of_ids([part])
        words = self.enc.words(part)
        if len(words) == 1:
            return self.word_entry(part)
        ids, pieces = zip(*[self.known(w, self.word_entry) for w in words])
        return b" ".join(ids), b" ".join(pieces)

    def word_entry(self, word: str) -> tuple[bytes, bytes]:
        ids = self.enc.word(word)
        if self.decoder.feed_all(ids) != word + " ":
            raise AssertionError(f"{word[:40]!r} does not come back from its ids")
        return self.of_ids(ids)

    def of_ids(self, ids) -> tuple[bytes, bytes]:
        said = self.said
        try:
            numbers, pieces = zip(*[said[i] for i in ids])
        except KeyError:
            said.update((i, (b"%d" % i, self.pieces.piece(i).encode())) for i in ids)
            return self.of_ids(ids)
        return b" ".join(numbers), b" ".join(pieces)

    def known(self, part, make) -> tuple[bytes, bytes]:
        e = self.memo.get(part)
        if e is None:
            e = self.old.get(part) or make(part)
            if isinstance(part, int) or len(part) <= 64:
                if len(self.memo) >= MEMO:
                    self.old = self.memo
                    self.memo = {}
                self.memo[part] = e
        return e

    def digest(self, text: str | None) -> tuple[int, str, str]:
        """(number of ids, SHA-256 of the ids, SHA-256 of the decoded text)."""
        n, ids_sha, text_sha, lead = 0, hashlib.sha256(), hashlib.sha256(), b""
        parts = self.enc.parts(text)
        while run := list(islice(parts, 50_000)):  # so many stretches of a long text at a time
            found = list(map(self.memo.get, run))
            if None in found:
                found = [self.known(p, self.entry) if e is None else e for p, e in zip(run, found)]
            numbers, pieces = zip(*found)
            ids = b" ".join(numbers)
            n += ids.count(b" ") + 1
            ids_sha.update(lead + ids)
            text_sha.update(lead + b" ".join(pieces))
            lead = b" "
        return n, ids_sha.hexdigest(), text_sha.hexdigest()
