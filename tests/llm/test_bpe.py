import random
from pathlib import Path

import pytest
import regex

from adlens.llm import bpe, p6

FILE = Path(p6.TOKENIZERS) / "byte_bpe_50k.tiktoken"
pytestmark = pytest.mark.skipif(not FILE.exists(), reason="no public vocabulary here")

TEXTS = [
    "", "a", "Hello, world! It's 2024.", "Растяжка на заборе обещает: утюг? сковорода!", "<|endoftext|> as text", "  two  spaces \n\n\t tabs ", "x" * 700, "-" * 400 + "=" * 99,
    "日本語テキスト 🎉👍🏽", "don't we'll I'M they've", "​﻿\r\n", "é й", "antidisestablishmentarianism " * 50,
]


def test_ids_equal_the_public_library():
    from tokenizers import Tokenizer

    r = random.Random(4)
    texts = TEXTS + ["".join(r.choice("abcdetiosn THE-_=.,0123абвгдеё\n‍€") for _ in range(150)) for _ in range(500)]
    t = Tokenizer.from_file(str(Path(p6.TOKENIZERS) / "byte_bpe_50k.json"))
    t.encode_special_tokens = True
    machine, cut = bpe.Transducer(bpe.read_ranks(str(FILE))), regex.compile(p6.WORDS).findall
    want = [e.ids for e in t.encode_batch(texts, add_special_tokens=False)]
    assert [p6.encode_text(machine, cut, x) for x in texts] == want


def test_states_may_be_dropped_at_any_time(monkeypatch):
    ranks = bpe.read_ranks(str(FILE))
    cut = regex.compile(p6.WORDS).findall
    want = [p6.encode_text(bpe.Transducer(ranks), cut, x) for x in TEXTS]
    monkeypatch.setattr(bpe, "MAX_STATES", 3)
    monkeypatch.setattr(bpe, "MAX_WORDS", 1)
    small = bpe.Transducer(ranks)
    assert [p6.encode_text(small, cut, x) for x in TEXTS] == want


def test_tokens_are_emitted_before_the_word_ends():
    machine = bpe.Transducer(bpe.read_ranks(str(FILE)))
    fed = []

    def source():
        for b in b"internationalisation" * 20:
            fed.append(b)
            yield b

    stream = machine.stream(source())
    next(stream)
    assert len(fed) < 60


def test_small_vocabulary_equals_merging():
    r = random.Random(6)
    ranks = {bytes([c]): c for c in range(256)}
    while len(ranks) < 330:
        a, b = (r.choice([t for t in ranks if len(t) < 5 and set(t) <= set(b"abc")]) for _ in range(2))
        machine = bpe.Transducer(ranks)
        if a + b not in ranks and machine.merge(a) == [a] and machine.merge(b) == [b] and len(machine.merge(a + b)) == 2:
            ranks[a + b] = len(ranks)
    machine = bpe.Transducer(ranks)
    for _ in range(2000):
        w = bytes(r.choice(b"abc") for _ in range(r.randrange(1, 14)))
        assert list(machine.encode(w)) == [ranks[t] for t in machine.merge(w)], w


def test_utf8_machine_equals_python():
    r = random.Random(8)
    for _ in range(2000):
        data = bytes(r.choice([0x41, 0x7F, 0x80, 0xBF, 0xC2, 0xD0, 0xE0, 0xA0, 0xED, 0x9F, 0xF0, 0x90, 0xF4, 0x8F, 0xFF]) for _ in range(r.randrange(0, 9)))
        m = bpe.Utf8()
        out = "".join(m.feed(data[i : i + 2]) for i in range(0, len(data), 2)) + m.close()
        assert out == data.decode("utf-8", "replace"), data


def test_results_leave_in_small_batches(spark, monkeypatch):
    df = spark.createDataFrame(list(enumerate(TEXTS)), "doc_id long, text string").coalesce(1)
    want = sorted((r.doc_id, r.ids) for r in p6.encoded(df).collect())
    monkeypatch.setattr(p6, "MAX_IDS", 1)
    assert sorted((r.doc_id, r.ids) for r in p6.encoded(df).collect()) == want


def test_round_trip_of_a_table(spark):
    rows = [(i, t) for i, t in enumerate(TEXTS)] + [(100, None), (101, "слово " * 20000), (100, None)]
    df = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "1 as ids")
    ids = p6.encoded(df)
    assert ids.schema.simpleString() == "struct<doc_id:bigint,ids:array<int>>"
    got = {r.doc_id: r.ids for r in ids.collect()}
    assert got[100] == [] and got[0] == [] and ids.count() == len(rows)
    back = {r.doc_id: r.text for r in p6.decoded(ids).collect()}
    assert all(back[i] == (t or "") for i, t in rows)
    assert p6.encoded(df.limit(0)).count() == 0
