"""What goes into the digests is made once for each distinct word, and says what ids and decoding say."""

from caremill.llm import bpe


def test_digests_are_made_once_a_word(tmp_path, monkeypatch):
    bpe.Lexicon.compiled([], []).save(f"file://{tmp_path}/lexicon")
    path, calls, written = bpe.tokenizer_path(), [], bpe.Codec.written
    monkeypatch.setattr(bpe.Codec, "written", lambda self, ids: calls.append(ids) or written(self, ids))
    texts = ["one two, one's two " * 50, "two\x1cthree <|endoftext|> é1 " * 20, "", None, " \n "]
    plain, codec = bpe.Codec(path, f"file://{tmp_path}/lexicon"), bpe.Codec(path, f"file://{tmp_path}/lexicon", digests=True)
    want = [(len(ids), " ".join(map(str, ids)).encode(), plain.decode(ids).encode()) for ids in plain.encode_all(texts)]
    assert [bpe.joined(x) for x in codec.pieces(texts)] == want and len(calls) < 20
