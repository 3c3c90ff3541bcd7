import public_tokenizers

from llm.byte_bpe import RANKS, ByteBpe


def test_pieces_in_use_stay_in_a_full_table():
    """A word of every batch is worked out once, however many rare ones pass through the table."""
    bpe = ByteBpe(RANKS, public_tokenizers.PATTERN, cache=8)
    merged, plain = [], bpe.merged
    bpe.merged = lambda pieces: merged.extend(pieces) or plain(pieces)
    ids = [bpe.encode([f"zqxwvkj rare{n}zq{n}", None, ""]) for n in range(20)]
    assert merged.count(b"zqxwvkj") == 1
    assert len(bpe.known) + len(bpe.older) < 30
    assert [bpe.decode(i[0]).decode() for i in ids] == [f"zqxwvkj rare{n}zq{n}" for n in range(20)]
    fresh = ByteBpe(RANKS, public_tokenizers.PATTERN)
    assert ids == [fresh.encode([f"zqxwvkj rare{n}zq{n}", None, ""]) for n in range(20)]
