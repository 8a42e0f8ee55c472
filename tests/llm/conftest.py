import pytest

FIELDS = "doc_id long, text string, source string, lang string, key string, size int, n_lines int"
WORDS = ["amber", "birch", "cedar", "delta", "ember", "fjord", "grove", "heron", "inlet", "jetty", "knoll", "lagoon",
         "meadow", "north", "oasis", "pine", "quarry", "ridge", "shore", "tundra", "upland", "valley", "willow"]


def prose(seed: int, n: int) -> str:
    """Text without repeated five-word windows across seeds."""
    out, state = [], seed * 7919 + 13
    for i in range(n):
        state = (state * 1103515245 + 12345) % (1 << 31)
        out.append(WORDS[(state >> 8) % len(WORDS)] + (f"{chr(97 + seed % 26)}{chr(97 + i % 26)}" if i % 3 == 0 else ""))
        if i % 17 == 16:
            out[-1] += ".\n" + "Next"
    return " ".join(out)


@pytest.fixture(scope="session")
def edge_rows():
    """Nulls in every column, empty, blank and long texts, ties, repeated rows, and columns whose names clash."""
    texts = [
        None, "", "   \n\t\x0b", "a", "one two three four", "Mixed CASE words and more words here",
        "line one\nline one\nline two\n\n line one", "#*$%&|<> # symbols", "x y z x y z x y z x y z",
        "naïve café 中文字 😀 words", "<|endoftext|> is plain text here", prose(1, 120), prose(1, 120),
        prose(1, 119) + " changed", prose(2, 300), prose(2, 300) + " tail", prose(3, 9000), "a" * 5000,
        prose(4, 80), "tab\there \x1c odd \x85 spaces   em",
    ]
    rows = [(i, t, f"s{i % 4}", "en", "k", 7, 9) for i, t in enumerate(texts)]
    rows += [(14, texts[14], None, None, None, None, None), (50, texts[14], "s1", None, "k", None, None)]
    rows += [(60, prose(5, 70), None, "en", "k", 1, 1)] * 2
    rows += [(None, prose(6, 60), "s2", "en", None, 1, 1)]
    return rows


@pytest.fixture(scope="session")
def edge_docs(spark, edge_rows):
    return spark.createDataFrame(edge_rows, FIELDS).repartition(3)


@pytest.fixture(scope="session")
def no_docs(spark):
    return spark.createDataFrame([], FIELDS)
