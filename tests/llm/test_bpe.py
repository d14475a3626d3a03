import random

import pytest

from palimpsest.llm._bpe import LANE, transducer

public_tokenizers = pytest.importorskip("public_tokenizers")
PATH = public_tokenizers.path("byte_bpe_50k.json")


def library(texts):
    from tokenizers import Tokenizer

    return [x.ids for x in Tokenizer.from_file(PATH).encode_batch(texts, add_special_tokens=False)]


def random_texts(n=400):
    rng = random.Random(5)
    pieces = ["'s", "'re", "'r", "'v", "'ll", "'l", "'t", " '", "''", "a", "store", " the", "  ", " ", "\n", "\n\n", "\t", "12", " 7", "!", "?!", "é", "łódź", "中文", "½", " ", " ", "\U0001f600", "<|endoftext|>", "<|end", "e", "r", "E", "Hello", "ing", "́", "x" * 60, "ab" * 40]
    return ["".join(rng.choice(pieces) for _ in range(rng.randrange(0, 40))) for _ in range(n)]


@pytest.mark.parametrize("texts", [["", " ", "'", "a", "\n", "'r", "'re", "  a", "a  ", "<|endoftext|>"], random_texts(), ["word " * 5000 + "'ll", "z" * 3000, " " * (LANE * 3), "a'" * LANE]])
def test_equals_library(texts):
    t = transducer(PATH)
    expected = library(texts)
    assert [x.tolist() for x in t.encode(texts)] == expected
    assert t.counts(texts).tolist() == [len(x) for x in expected]


def test_small_cache_is_rebuilt(monkeypatch):
    import palimpsest.llm._bpe as m

    monkeypatch.setattr(m, "KEEP", 50)
    monkeypatch.setattr(m, "CHUNK_CHARS", 200)
    t = m.Transducer(PATH)
    texts = random_texts(60)
    assert [x.tolist() for x in t.encode(texts)] == library(texts)


@pytest.mark.parametrize("tail", [1, 2, 16])
def test_tails_that_settle_no_lane_are_read_whole(monkeypatch, tail):
    import palimpsest.llm._bpe as m

    monkeypatch.setattr(m, "TAIL", tail)
    monkeypatch.setattr(m, "LANE", 8)
    read, t = [], m.Transducer(PATH)
    real = t.maps
    monkeypatch.setattr(t, "maps", lambda c: read.append(c.size) or real(c))
    texts = random_texts(100) + ["it's's's we'll'll 12 " * 9, "'s" * 40, "''" * 40, " ' " * 40]
    assert [x.tolist() for x in t.encode(texts)] == library(texts)
    assert len(read) > 1 and read[1] > 0 if tail == 1 else True


def test_ordinary_text_is_read_by_tails(monkeypatch):
    import palimpsest.llm._bpe as m

    read, t = [], m.Transducer(PATH)
    real = t.maps
    monkeypatch.setattr(t, "maps", lambda c: read.append(c.size) or real(c))
    t.counts(["It's an ordinary text, of 12 words or  so.\n" * 200])
    assert sum(read) * LANE <= 200 * 43 * 16 + 16 * LANE


def test_merging_looks_up_no_padding_of_other_lengths(monkeypatch):
    import palimpsest.llm._bpe as m

    rng = random.Random(3)
    words = sorted({"".join(rng.choice("etaoinshr") for _ in range(13)) for _ in range(300)} | {"".join(rng.choice("etaoinżł") for _ in range(21)) for _ in range(30)})
    asked, t = [], m.Transducer(PATH)
    real = t.ranks
    monkeypatch.setattr(t, "ranks", lambda a, b: asked.append(b.size) or real(a, b))
    got = [x.tolist() for x in t.encode(words)]
    assert got == library(words)
    by_length = {n: sum(len(w.encode()) == n for w in words) for n in {len(w.encode()) for w in words}}
    merges = sum(len(w.encode()) - len(x) for w, x in zip(words, got, strict=True))
    # a block is as wide as its longest pretoken; here there is one block
    assert sum(asked) <= max(by_length) * len(words) + 2 * merges and sum(by_length.values()) < m.BLOCK
    asked.clear()
    same = [w for w in words if len(w.encode()) == 13]
    t.reset()
    merges = sum(len(w.encode()) - len(x) for w, x in zip(same, t.encode(same), strict=True))
    assert sum(asked) <= 13 * len(same) + 2 * merges


def test_known_pretokens_are_not_copied_for_each_new_one():
    import palimpsest.llm._bpe as m

    t, pools = m.Transducer(PATH), []
    texts = [f"qz{k}x {k * 7919}" for k in range(400)]
    got = []
    for x in texts:
        got.append(t.encode([x])[0].tolist())
        pools.append(t.pool)
    assert got == library(texts) and len({id(x) for x in pools}) <= 20


def test_a_run_of_lanes_that_no_character_settles():
    import palimpsest.llm._bpe as m

    t = m.Transducer(PATH)
    texts = ["'" * (LANE * 5) + "s", "r" * LANE, "'re" * LANE + " " * (LANE * 3) + "x", "ab " * LANE, "''s" * (LANE * 2)]
    assert [x.tolist() for x in t.encode(texts)] == library(texts)


def test_rows_of_merges_that_find_no_room_go_behind_the_others(monkeypatch):
    import palimpsest.llm._bpe as m

    monkeypatch.setattr(m, "TRIES", 1)
    t = m.Transducer(PATH)
    assert len(t.owner) > 8 * len(t.merge) + t.width + 1 and (t.owner >= 0).sum() == len(t.merge)
    a, b = (m.np.array(x, m.np.int32) for x in zip(*(divmod(k, int(t.width)) for k in t.merge), strict=True))
    assert t.ranks(a, b).tolist() == [x[0] for x in t.merge.values()] and t.made[t.ranks(a, b)].tolist() == [x[1] for x in t.merge.values()]
    texts = random_texts(60)
    assert [x.tolist() for x in t.encode(texts)] == library(texts)
