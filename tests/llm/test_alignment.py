"""Alignment against a plain version: whole texts through the tokenizers as
published, all pairs of tokens."""

import hashlib
import random
from collections import Counter, defaultdict

import pytest
import sentencepiece
from tokenizers import Tokenizer

from tempograin.llm import alignment

A, B = (f"{alignment.tokenizer_folder()}/{f}" for f in ("byte_bpe_50k.json", "piece_bpe_32k.model"))


def spans(parts):
    out, at = [], 0
    for i, x in parts:
        out.append((i, at, at + len(x)))
        at += len(x)
    return out


def plain(texts):
    a, b = Tokenizer.from_file(A), sentencepiece.SentencePieceProcessor(model_file=B)
    a.encode_special_tokens = True
    shown = {c: i for i, c in enumerate(alignment._byte_characters())}
    encoded, count = [], Counter()
    for t in texts:
        whole = (" " + (t or "")).encode()
        x = spans([(i, bytes(shown[c] for c in a.id_to_token(i))) for i in a.encode(" " + (t or ""), add_special_tokens=False).ids])
        y = spans([(i, bytes([int(b.id_to_piece(i)[3:5], 16)]) if b.is_byte(i) else b.id_to_piece(i).replace("▁", " ").encode()) for i in b.encode(t or "")])
        back = all(b"".join(p) == whole for p in ([bytes(shown[c] for c in a.id_to_token(i)) for i, *_ in x], [bytes([int(b.id_to_piece(i)[3:5], 16)]) if b.is_byte(i) else b.id_to_piece(i).replace("▁", " ").encode() for i, *_ in y]))
        if not t or not back:
            x, y = [], []
        links = [(j, i) for i, s, e in x for j, f, g in y if s < g and f < e] if len(x) < 5000 else None
        encoded.append((x, y, links))
        count.update(links or [])
    best = defaultdict(int)
    for (j, _), n in count.items():
        best[j] = max(best[j], n)
    out = []
    for x, y, links in encoded:
        cuts = sorted({e for *_, e in x} & {e for *_, e in y})
        parts, low = [], 0
        for cut in cuts:
            parts.append(",".join(str(i) for i, s, e in x if low < e <= cut) + "|" + ",".join(str(i) for i, s, e in y if low < e <= cut))
            low = cut
        out.append((len(x), len(y), len(cuts), len(links), sum(count[k] == best[k[0]] for k in links), sum(count[k] for k in links), hashlib.sha256(";".join(parts).encode()).hexdigest() if x else ""))
    return out, count


ODD = [None, "", " ", "  ", "a", " a", "a ", "  two  blanks ", "a b c  d", "x　y z", "tab\tand\nline \n feed", "▁piece▁mark", "ok ▁ not", "<|endoftext|> <s> </s> <unk> <0x41>", "don't we'll I'M", "漢字 かな 한국어", "émile à côté", "🙂🙂 👩‍👩‍👧", " x   y", "\x1c \x1d a \x85 b", "ﬁ ½ ①", "0 12 345 6789", "the the the the", "the the the the", "x" * 3000, "a\0b \0 c", "é é", "​ zero", "ab " * 300]


def fuzz(n):
    rng = random.Random(4)
    signs = list("ab eE1'. \t\n-_,é漢▁  　🙂ß\x1f\x85́") + ["  ", " the", " of", "<s>", "n't"]
    return ["".join(rng.choices(signs, k=rng.randint(1, 40))) for _ in range(n)]


def rows_of(spark, texts, **limits):
    df = spark.createDataFrame([(i, t, 1, "x", "y") for i, t in enumerate(texts)], "doc_id long, text string, slice int, radix string, run string")
    return [tuple(r)[1:] for r in sorted(alignment.align(df, **limits).collect(), key=lambda r: r["doc_id"])], df


@pytest.mark.parametrize("limit", [None, 1])
def test_against_plain(spark, limit):
    texts = ODD + fuzz(400)
    want, count = plain(texts)
    got, df = rows_of(spark, texts, **({"radix_block": limit} if limit else {}))
    assert got == want
    pairs = {(r["b_id"], r["a_id"]): r["n"] for r in alignment.pair_counts(df).collect()}
    assert pairs == dict(count)


@pytest.mark.parametrize("last", ["a ", "of 漢 e ", "ab " * 300, "a", " ", "x\u3000 "])
def test_last_text_of_a_slice(last):
    """A blank that ends the last text is as one that ends any other."""
    texts = ["two words", last]
    want, count = plain(texts)
    found, pair, _, links = alignment.digest(alignment.vocabularies(A, B), [t.encode() for t in texts])
    assert [(*n, sha) for sha, *n in found] == [(*w[:4], w[6]) for w in want]
    assert sum(links.tolist()) == sum(count.values()) and set(pair.tolist()) == {b << alignment._ID_BITS | a for b, a in count}


def test_encoders_agree_on_every_character():
    """Units are split as the published tokenizer splits them, whatever stands beside a character."""
    a, v = Tokenizer.from_file(A), alignment.vocabularies(A, B)
    a.encode_special_tokens = True
    codes = [c for c in range(0x110000) if not 0xD800 <= c < 0xE000]
    for low in range(0, len(codes), 40_000):
        text = [f" a{chr(c)}1 {chr(c)}{chr(c)}!{chr(c)} {chr(c)}" for c in codes[low : low + 40_000]]
        want = [e.ids for e in a.encode_batch(text, add_special_tokens=False)]
        bad = [t for t, w in zip(text, want, strict=True) if v.a.encode_ordinary(t) != w]
        assert not bad, bad[:5]


def test_long_and_empty(spark):
    none = spark.createDataFrame([], "doc_id long, text string")
    assert alignment.align(none).count() == 0 == alignment.pair_counts(none).count()
    text = " ".join(f"word{i % 977}" for i in range(60_000))
    (one, two, three), _ = rows_of(spark, [text, text, "z" * 200_000])
    assert one == two and one[0] > 60_000 and one[3] == one[0] + one[1] - one[2] and three[3] > 0


def test_radix_runs_are_merged_whole(spark):
    """Many slices: runs of several blocks add up to the same counts."""
    texts = fuzz(300) + ["the same words again and again"] * 50
    want = plain(texts)[0]
    assert rows_of(spark, texts, radix_block=3, slice_bytes=2_000)[0] == want
