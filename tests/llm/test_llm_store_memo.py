"""What the token store's encoder remembers."""

from coursemart.llm import common, token_store


def test_store_remembers_400_000_units():
    asked = []

    def encode_units(units):
        asked.extend(units)
        return [b"x"] * len(units)

    memo = common.Memo(token_store.STORE_UNITS)
    for _ in range(2):
        for i in range(0, 400_000, 1000):
            common.encode_by_unit(" ".join(["first", *map(str, range(i, i + 1000))]), memo, encode_units, lambda t: b"")
    assert len(asked) == 400_000
