"""Strip, word tokens and token windows."""

from hypothesis import given, settings
from hypothesis import strategies as st

from tidings.functions.chunk import chunk_count, chunk_step, chunks_from_tokens
from tidings.functions.text import WHITESPACE, n_words, py_strip, words


def loop_windows(tokens, m, o):
    """The window loop, written plainly, as the spec for the closed form."""
    if not tokens:
        return []
    if len(tokens) <= m:
        return None  # pass-through
    out, pos = [], 0
    while pos < len(tokens):
        end = min(pos + m, len(tokens))
        out.append((pos, end - pos))
        if end == len(tokens):
            break
        adv = m - o
        if adv <= 0:
            adv = m // 2 if m > 1 else 1
        pos += adv
    return out


def test_strip_and_words_match_python(spark):
    texts = ["\u3000\t hello  world\xa0\n", "", "\x1c x \x1f", None, "a b",
             "  one\ntwo\r\nthree  "]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    rows = df.select("t", py_strip("t").alias("s"), words("t").alias("w"),
                     n_words("t").alias("n")).collect()
    for r in rows:
        assert (r.s or "") == (r.t or "").strip()
        assert (r.w or []) == (r.t or "").split()
        assert r.n == len((r.t or "").split())
    assert "".join(sorted(WHITESPACE)) == "".join(
        c for c in map(chr, range(0x110000)) if c.isspace())


def _chunks(spark, text, m, o):
    df = spark.createDataFrame([(text,)], "t string").withColumn("tok", words("t"))
    return df.select(chunks_from_tokens("t", "tok", m, o).alias("c")).first().c


def test_chunk_examples_from_reference_tests(spark):
    c = _chunks(spark, "one two three four five six seven eight nine ten", 4, 1)
    assert [x.chunk for x in c] == ["one two three four", "four five six seven",
                                    "seven eight nine ten"]
    assert [x.start_tok for x in c] == [0, 3, 6]
    # fits in one window: the original text, verbatim
    c = _chunks(spark, "short  text\n", 5, 1)
    assert [x.chunk for x in c] == ["short  text\n"]
    assert _chunks(spark, "", 5, 1) == []
    assert _chunks(spark, " \t\n", 5, 1) == []


def test_guard_and_bad_settings(spark):
    text = " ".join(f"w{i}" for i in range(10))
    c = _chunks(spark, text, 4, 4)          # m <= o: advance m div 2
    assert [x.start_tok for x in c] == [0, 2, 4, 6]
    c = _chunks(spark, text, 1, 3)          # m = 1: advance 1
    assert len(c) == 10
    assert _chunks(spark, text, 0, 1) is None   # rejected, not cut
    assert _chunks(spark, text, 4, -1) is None


@settings(max_examples=300, deadline=None)
@given(n=st.integers(0, 60), m=st.integers(1, 20), o=st.integers(0, 25))
def test_closed_form_equals_loop(n, m, o):
    # the closed form, evaluated in plain Python with the same formulas
    step = m - o if m > o else (m // 2 if m > 1 else 1)
    cnt = 0 if n == 0 else 1 if n <= m else (n - m + step - 1) // step + 1
    want = loop_windows(list(range(n)), m, o)
    if want is None:
        assert cnt == 1
    else:
        got = [(i * step, min(m, n - i * step)) for i in range(cnt)]
        assert got == want


def test_closed_form_in_spark_matches_loop(spark):
    rows = [(n, m, o) for n in (0, 1, 5, 9, 10, 11, 37) for m in (1, 2, 4, 10)
            for o in (0, 1, 3, 10, 12)]
    df = spark.createDataFrame(rows, "n int, m int, o int")
    got = df.select("n", "m", "o", chunk_step("m", "o").alias("s"),
                    chunk_count("n", "m", "o").alias("c")).collect()
    for r in got:
        want = loop_windows(list(range(r.n)), r.m, r.o)
        assert r.c == (1 if want is None else len(want))


def test_windows_cover_all_tokens_with_overlap(spark):
    text = " ".join(f"t{i}" for i in range(103))
    c = _chunks(spark, text, 10, 3)
    toks = text.split()
    seen = set()
    for a, b in zip(c, c[1:]):
        assert toks[b.start_tok:b.start_tok + 3] == toks[a.start_tok + 7:a.start_tok + 10]
    for x in c:
        seen.update(range(x.start_tok, x.start_tok + x.n_tok))
        assert x.chunk == " ".join(toks[x.start_tok:x.start_tok + x.n_tok])
    assert seen == set(range(103))
