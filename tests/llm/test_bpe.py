import array

import pytest

from martkit.llm import bpe

from .conftest import frame


@pytest.fixture(scope="module")
def library():
    return bpe.encoding(bpe.read_ranks(), bpe.public_tokenizers.PATTERN)


@pytest.mark.parametrize("chunk,overlap", [(1 << 16, 1 << 12), (40, 20), (16, 16), (64, 8)])
def test_ids_equal_the_library_and_decode(spark, corpus, library, chunk, overlap):
    texts = corpus + ["It's  we'll\n\n  'reap 12 345!! \n x", "a" * 333 + " b " + " " * 99 + "c'd"]
    df = frame(spark, texts, ids="clash", ext=1)
    out = bpe.decode(bpe.encode(df, chunk=chunk, overlap=overlap)).collect()
    assert len(out) == len(texts)
    for r in out:
        text = texts[r.doc_id] or ""
        assert bytes(r.ids) == array.array("I", library.encode_ordinary(text)).tobytes()
        assert bytes(r.decoded) == text.encode()
        assert r.ext == 1


def test_empty_table_and_unknown_id(spark):
    assert bpe.encode(frame(spark, [])).count() == 0
    bad = spark.createDataFrame([(b"\xff\xff\xff\xff",)], "ids binary")
    with pytest.raises(Exception, match="KeyError"):
        bpe.decode(bad).collect()


def test_cut_points_stop_at_the_first_gap():
    chunks = [(0, [], [11, 14]), (10, [14], [22]), (20, [23], [33]), (30, [33], [])]
    assert bpe.cut_points(chunks) == [14]
