import sentencepiece
from cases import LONG, PIECES, ROWS, documents, empty, given
from hypothesis import given as cases_of
from hypothesis import settings
from hypothesis import strategies as st

from tripkpi.llm import token_counts, wfst
from tripkpi.llm.pieces import pre_tokens, read_model

LIBRARY = sentencepiece.SentencePieceProcessor(model_file=PIECES)
FST = wfst.transducer(PIECES)

PARTS = st.sampled_from(
    ["a", "th", "e ", " ", "  ", "\n", "é", "日", "𝄞", "▁", "<s>", "\x00", "1", "\t", "ing", "tion", "​"]
)


@settings(max_examples=300, deadline=None)
@cases_of(st.one_of(st.text(max_size=40), st.lists(PARTS, max_size=30).map("".join)))
def test_ids_are_the_library_s(text):
    text = text.encode("utf-8", "ignore").decode()
    ids = list(FST.encode(text))
    assert ids == LIBRARY.encode(text)
    assert FST.decode(ids) == text.replace("▁", " ")


def test_small_caches_change_nothing():
    small = wfst.Transducer(read_model(PIECES), 3)
    for _ in range(2):
        for text in ("a b a c d e f a b " * 9, LONG[:20_000]):
            assert list(small.encode(text)) == LIBRARY.encode(text)
    assert len(small.words) <= 3 and len(small.words.older) <= 3


def test_long_words_take_linear_time():
    for text in ("a" * 30_000, "abcdefgh" * 5_000, LONG):
        assert list(FST.encode(text)) == LIBRARY.encode(text)


def test_least_path_of_a_unigram_model():
    pieces = ("<unk>", "▁", "a", "b", "ab", "▁a")
    scores = (0.0, -5.0, -3.0, -3.0, -2.0, -2.5)
    model = type(read_model(PIECES))(1, pieces, scores, (2, 1, 1, 1, 1, 1), True, False, False)
    fst = wfst.Transducer(model)
    # ▁a + b costs 5.5, ▁ + ab costs 7, ▁ + a + b costs 11.
    assert [pieces[i] for i in fst.encode("ab")] == ["▁a", "b"]
    assert list(fst.encode("zb"))[1:] == [0, 3]


def test_encode_and_decode_tables(spark):
    for table in (documents(spark), given(spark, "documents")):
        want = sorted(
            (str(r.doc_id), LIBRARY.encode(r.text or "")) for r in table.select("doc_id", "text").collect()
        )
        coded = wfst.encode(table, PIECES)
        assert sorted((str(r.doc_id), r.token_ids) for r in coded.collect()) == want
        back = wfst.decode(coded.where("round_trip"), PIECES)
        texts = {str(r.doc_id): r.text or "" for r in table.select("doc_id", "text").collect()}
        for row in back.where("doc_id < 7 OR doc_id > 8").collect():
            assert row.text == texts[str(row.doc_id)]
    assert wfst.encode(empty(spark), PIECES).count() == 0
    assert [r.round_trip for r in wfst.encode(documents(spark), PIECES).where("doc_id = 8").collect()] == [False]


@settings(max_examples=300, deadline=None)
@cases_of(st.one_of(st.text(alphabet=" ab▁\n", max_size=12), st.lists(PARTS, max_size=30).map("".join)))
def test_lengths_add_up_to_the_library_s(text):
    lengths = token_counts._Lengths(PIECES, {})
    assert sum(lengths[x] for x in pre_tokens(text, read_model(PIECES))) == len(LIBRARY.encode(text))


def test_counts_are_the_library_s_with_any_first_tier(spark):
    for table, frequent in ((documents(spark), 3), (given(spark, "documents"), 50_000)):
        got = token_counts.count_tokens(table, PIECES, limit=100, frequent=frequent)
        want = []
        for row in table.select("doc_id", "text").collect():
            text = row.text or ""
            n = len(LIBRARY.encode(text))
            want.append((str(row.doc_id), len(text.encode()), n, n > 100))
        assert sorted((str(r[0]), *r[1:]) for r in got.collect()) == sorted(want)
    assert len(ROWS) == token_counts.count_tokens(documents(spark), PIECES).count()
    assert token_counts.count_tokens(empty(spark), PIECES).count() == 0
