import os
import random

import pytest
import sentencepiece
from brute import awkward, empty

from tallyhouse.llm import pieces

PATH = os.path.join(pieces.TOKENIZERS, pieces.MODEL)
FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def own():
    return pieces.Encoder(pieces.load_vocabulary(PATH))


def whole(vocabulary, text):
    """Viterbi over the whole text at once: the score of its best segmentation."""
    best = [0.0]
    for end in range(1, len(text) + 1):
        ways = [best[s] + vocabulary.scored[text[s:end]][0] for s in range(max(0, end - vocabulary.longest), end)
                if text[s:end] in vocabulary.scored]
        if text[end - 1] not in vocabulary.scored:
            ways.append(best[end - 1] + vocabulary.lowest - pieces.UNKNOWN_PENALTY)
        best.append(max(ways))
    return best[-1]


def value(vocabulary, ids):
    total, pending = 0.0, b""
    for i in ids:
        byte = vocabulary.byte_value(i)
        if byte is None:
            total += vocabulary.scores[i]
        else:
            pending += bytes([byte])
            try:
                pending.decode()
            except UnicodeDecodeError:
                continue
            total, pending = total + vocabulary.lowest - pieces.UNKNOWN_PENALTY, b""
    return total


def texts():
    draw = random.Random(11)
    out = ["", " ", "  a  b ", "a", "\n\n", "trailing  ", "漢字 \U0001f600\U0001f600 zero​width", "x" * 3000, "ab" * 900, " " * 100]
    for _ in range(150):
        out.append("".join(draw.choice("aabcdehiinorst  \n.,éß\U0001f600漢") for _ in range(draw.randint(1, 120))))
    return out


def test_vocabulary_as_the_library_reads_it(own):
    library = sentencepiece.SentencePieceProcessor(model_file=PATH)
    assert [library.id_to_piece(i) for i in range(library.get_piece_size())] == own.vocabulary.texts
    assert [library.get_score(i) for i in range(library.get_piece_size())] == pytest.approx(own.vocabulary.scores)


def test_best_segmentation(own):
    for text in texts():
        ids = own.encode(text)
        assert value(own.vocabulary, ids) == pytest.approx(whole(own.vocabulary, pieces.normalise(text)))
        assert own.decode(ids) == text


def test_streams_equal_segments(own):
    """Committing by converged paths alone, without the words' boundaries, gives as good a segmentation."""
    for text in texts():
        streamed = [i for part in own.stream(pieces.normalise(text)) for i in part]
        assert value(own.vocabulary, streamed) == pytest.approx(value(own.vocabulary, own.encode(text)))
        assert own.decode(streamed) == text


def test_no_piece_is_cut(own):
    """Every piece as a text, alone and in other text, has the ids of the path that is not cut."""
    made = [t for p in own.vocabulary.ids for t in (p, f"m{p} a", f"12{p}.")] + ["12 m². "]
    for text, ids in zip(made, own.encode_all(made)):
        assert ids == [i for part in own.stream(pieces.normalise(text)) for i in part], text
    assert own.vocabulary.cuts is not pieces._WORDS


def test_pieces_over_letters_and_signs_keep_words_whole():
    texts = ["a", ".", "a.", "²", "².", "½b"]
    for kept, whole_words in ((texts[:2], False), (texts[:3], True), (texts[:2] + texts[3:5], False), (texts, True)):
        vocabulary = pieces.Vocabulary({t: i for i, t in enumerate(kept)}, [-1.0] * len(kept), kept, [1] * len(kept))
        assert (vocabulary.cuts is pieces._WORDS) == whole_words
        own = pieces.Encoder(vocabulary)
        for text in ("a.", "².a", "a². ½b."):
            assert own.encode(text) == [i for part in own.stream(pieces.normalise(text)) for i in part]


def test_the_window_is_bounded(own):
    draw = random.Random(2)
    text = pieces.normalise(" ".join("".join(draw.choice("etaoinshr") for _ in range(draw.randint(2, 9))) for _ in range(20000)))
    list(own.stream(text))
    assert own.widest <= 4 * own.vocabulary.longest


def test_awkward(spark, own):
    docs = awkward(spark, [(20, "spaced   out"), (21, "sign ▁ here")])
    rows = pieces.encode_documents(docs).collect()
    assert len(rows) == docs.count()
    for r in rows:
        assert r.n_tokens == len(r.ids) and r.round_trip == (r.doc_id != 21)
    back = pieces.decode_documents(spark.createDataFrame([(1, [29871]), (2, None)], "doc_id long, ids array<int>")).collect()
    assert back[1].text is None


def test_empty(spark):
    assert pieces.encode_documents(empty(spark)).collect() == []


def test_table(spark, own):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    encoded = pieces.encode_documents(docs)
    assert encoded.filter("not round_trip").count() == 0
    back = pieces.decode_documents(encoded).exceptAll(docs.selectExpr("doc_id", "coalesce(text, '') as text")).count()
    assert back == 0
