"""Texts put together from words that the backend encodes once have the library's ids."""

import random

import public_tokenizers
import sentencepiece
from test_tokens import HARD, MODEL, message

from eventlake.llm import piece_model, sentence_pieces
from eventlake.llm.sentence_pieces import reads_back


def texts_of(seed):
    r = random.Random(seed)
    alphabet = ["a", "b", "the", "ing", " ", " ", " ", "  ", " " * 17, "\n", "\t", "▁", "é", "日", "🙂", "\u0000", "<0x0A>", ".", "1"]
    return [*HARD, *("".join(r.choices(alphabet, k=r.randint(0, 60))) for _ in range(400))]


def test_each_word_is_encoded_once_and_texts_have_the_library_s_ids(monkeypatch):
    ref, model = sentencepiece.SentencePieceProcessor(model_file=MODEL), piece_model.parsed(MODEL)
    words, asked = piece_model.WordIds(MODEL, model.words()), []
    encoded = piece_model.WordIds.encoded
    monkeypatch.setattr(piece_model.WordIds, "encoded", lambda self, new: asked.extend(new) or encoded(self, new))
    for seed in (1, 2, 1):
        texts = texts_of(seed)
        assert [x.tolist() for x in words.of(texts)] == ref.encode(texts)
    assert len(asked) == len(set(asked)) == len(words)
    words.of(["the same words again and again"] * 1000)
    assert len(asked) == len(set(asked)) == len(words) and words.met.max() >= 2000


def test_full_tables_keep_frequent_words(monkeypatch):
    monkeypatch.setattr(piece_model.WordIds, "WORDS", 40)
    monkeypatch.setattr(piece_model.WordIds, "IDS", 200)
    ref = sentencepiece.SentencePieceProcessor(model_file=MODEL)
    words = piece_model.WordIds(MODEL, piece_model.parsed(MODEL).words())
    assert words.of([]) == [] or all(not len(x) for x in words.of([]))
    for k in range(20):
        texts = [*texts_of(k)[:30], "often " * 50]
        assert [x.tolist() for x in words.of(texts)] == ref.encode(texts)
    words.thin()
    assert "▁often" in words and len(words) <= 20 and len(words.ids) <= 100


def test_joined_pieces_tell_what_the_decoder_tells():
    tok, model = piece_model.load(MODEL), piece_model.parsed(MODEL)
    surface = model.surfaces()
    for text in texts_of(3):
        ids = tok.encode(text, add_special_tokens=False).ids
        assert reads_back(text, ids, surface, True) == (tok.decode(ids, skip_special_tokens=False) == text) == ("▁" not in text)
    assert not reads_back("other", tok.encode("text", add_special_tokens=False).ids, surface, True)


def test_models_whose_words_depend_on_each_other_go_whole_to_the_backend(spark, tmp_path):
    pieces = [("<unk>", 0.0, 2), *[(f"<0x{b:02X}>", -20.0, 6) for b in range(256)], ("▁", -3.0, 1), ("a", -4.0, 1), ("b", -4.1, 1), ("a▁", -1.0, 1), ("a▁b", -0.5, 1)]
    data = b"".join(message((1, message((1, p.encode()), (2, s), (3, kind)))) for p, s, kind in pieces)
    data += message((2, message((3, piece_model.UNIGRAM), (35, 1))), (3, message((1, b"identity"), (3, 1), (4, 0), (5, 1))))
    path = tmp_path / "across.model"
    path.write_bytes(data)
    assert piece_model.parsed(str(path)).words() is None
    rows = sentence_pieces.encode(spark.createDataFrame([(1, "a b a"), (2, ""), (3, None)], "doc_id long, text string"), str(path)).collect()
    assert all(r.round_trip and r.parity for r in rows)


def test_unknown_characters_have_the_backend_s_ids(tmp_path):
    pieces = [("<unk>", 0.0, 2), ("▁", -3.0, 1), ("a", -4.0, 1), ("▁a", -1.0, 1)]
    data = b"".join(message((1, message((1, p.encode()), (2, s), (3, kind)))) for p, s, kind in pieces)
    data += message((2, message((3, piece_model.BPE), (35, 0))), (3, message((1, b"identity"), (3, 1), (4, 0), (5, 1))))
    path = tmp_path / "unknown.model"
    path.write_bytes(data)
    tok, texts = piece_model.load(str(path)), ["a aé日 é a", "日本", "", "a"]
    words = piece_model.WordIds(str(path), piece_model.parsed(str(path)).words())
    assert [x.tolist() for x in words.of(texts)] == [tok.encode(t, add_special_tokens=False).ids for t in texts]


def test_the_model_is_the_shipped_one():
    assert MODEL == public_tokenizers.path(sentence_pieces.MODEL) and piece_model.parsed(MODEL).words() is not None
