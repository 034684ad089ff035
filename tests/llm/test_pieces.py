"""What an encoder remembers."""

from tickloom.llm import records
from tickloom.llm.queries import tokenizer_path


def test_words_outlive_pieces(monkeypatch):
    """Words are remembered when pieces, of which there are more, have filled their store; the ids stay the same."""
    path = tokenizer_path()
    texts = [f"plain{chr(97 + i)} Plain{chr(97 + i)}, plain{chr(97 + i)}. the\tx{i}\n" for i in range(26)]
    whole = [records.PieceEncoder(path, False, "<u2")(t) for t in texts]
    monkeypatch.setattr(records, "CACHED", 30)
    encode = records.PieceEncoder(path, records.splits_at_spaces(path), "<u2")
    assert [encode(t) for t in texts] == whole
    assert "plaina" in encode.words and len(encode.pieces) <= 36
