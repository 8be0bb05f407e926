import hashlib
import random

import pytest
from tokenizers import Tokenizer

from waitband.llm import encoding
from waitband.llm.bpe import ByteDecoder, Digester, Encoder, Merges, tokenizer_path

from . import cases


@pytest.fixture(scope="module")
def theirs():
    return Tokenizer.from_file(tokenizer_path())


@pytest.fixture(scope="module")
def ours():
    return Encoder(tokenizer_path())


def samples():
    rng = random.Random(3)
    letters = "abcdeghinorstéüßñ'.-#1 "
    out = ["", "a", "a</w>", "<|endoftext|>", "x <|startoftext|>y<|endoftext|>", "Σας ΑΣ", "İ", "\x1c1a\x1f b", "'s 're ''ll #'s 12½",
           "é é ﬁ", "　a b c", "aaaa" * 999, "ha" * 700, "é" * 400, "=-" * 400, "x" * 3000 + "y", "日本語 текст 🙂🙂"]
    out += ["".join(rng.choice(letters) for _ in range(rng.randint(1, 300))) for _ in range(300)]
    out += ["".join(rng.choice(["the", "an", "in", "er", "ion", "t"]) for _ in range(900)) for _ in range(20)]
    return out


def test_ids_equal_the_library(theirs, ours):
    for text in samples():
        assert ours.encode(text) == theirs.encode(text, add_special_tokens=False).ids, text[:60]


def test_decoding_equals_the_library(theirs, ours):
    for text in samples():
        ids = ours.encode(text)
        assert ByteDecoder(ours.merges, "pieces").decode(ids) == theirs.decode(ids, skip_special_tokens=False)
        one_by_one = ByteDecoder(ours.merges, "pieces")
        assert "".join([*map(one_by_one.feed, ids), one_by_one.finish()]) == theirs.decode(ids, skip_special_tokens=False)


def test_running_text_round_trip(ours):
    text = "größe 🙂 日本 été niño x"
    words = ByteDecoder(ours.merges, "text").decode(ours.encode(text)).split()
    assert "".join(words) == text.replace(" ", "")


def plain_merge(merges: Merges, symbols: list[str]) -> list[str]:
    """Merging by rank, leftmost first: the definition."""
    while True:
        ranked = [(merges.rank.get(p, 1 << 60), k) for k, p in enumerate(zip(symbols, symbols[1:]))]
        if not ranked or min(ranked)[0] == 1 << 60:
            return symbols
        k = min(ranked)[1]
        symbols = symbols[:k] + [symbols[k] + symbols[k + 1]] + symbols[k + 2:]


def test_transducer_equals_the_definition_and_holds_little(ours):
    rng = random.Random(8)
    for _ in range(150):
        word = "".join(rng.choice("aeinorst") for _ in range(rng.randint(1, 60)))
        assert list(ours.transducer.word(word)) == plain_merge(ours.merges, [*word[:-1], word[-1] + "</w>"])
    word = "".join(rng.choice("aeinorst") for _ in range(20_000))
    held = []
    common = ours.transducer._common
    ours.transducer._common = lambda last: held.append(len(last)) or common(last)
    try:
        list(ours.transducer.word(word))
    finally:
        del ours.transducer._common
    assert max(held) <= 2 * ours.transducer.stride < ours.merges.lookahead


def test_every_code_point_is_classed_and_lowered_as_by_the_library(theirs, ours):
    pre = theirs.pre_tokenizer.pre_tokenize_str
    points = [chr(c) for c in range(0x110000) if not 0xD800 <= c < 0xE000]
    for ch in points:
        probe = f"a{ch}!"
        if [*ours.parts(ch)]:  # no white space
            assert ours.words(probe) == [probe[a:b] for _, (a, b) in pre(probe)], hex(ord(ch))
    for lo in range(0, len(points), 5000):
        text = " ".join(f"x{ch}x" for ch in points[lo:lo + 5000])
        assert [p for p in ours.parts(text) if isinstance(p, str)] == theirs.normalizer.normalize_str(text).split(" ")


def test_byte_machine_decodes_every_token(ours):
    text, pieces = ByteDecoder(ours.merges), ByteDecoder(ours.merges, "pieces")
    for token, i in ours.merges.vocab.items():
        if token not in ours.merges.special:
            assert pieces.piece(i) == token
    word = "größe🙂"
    ids = ours.encode(word)
    assert text.feed_all(ids[:2]) + text.feed_all(ids[2:]) + text.finish() == "größe 🙂 "


def test_digests(theirs):
    work = Digester(tokenizer_path())
    for text in samples():
        ids = theirs.encode(text, add_special_tokens=False).ids
        told = theirs.decode(ids, skip_special_tokens=False)
        assert work.digest(text) == (len(ids), hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256(told.encode()).hexdigest())


def test_table(spark, theirs):
    docs = cases.documents(spark)
    want = sorted((r.doc_id, len(theirs.encode(r.text or "", add_special_tokens=False).ids)) if r.doc_id is not None else (-1, len(theirs.encode(r.text or "", add_special_tokens=False).ids)) for r in docs.collect())
    got = sorted((-1 if r.doc_id is None else r.doc_id, r.n_tokens) for r in encoding.digests(docs, tokenizer_path()).collect())
    assert got == want
    assert encoding.digests(cases.empty(spark), tokenizer_path()).count() == 0
    back = encoding.decode(encoding.encode(docs, tokenizer_path()), tokenizer_path())
    assert back.count() == docs.count()
