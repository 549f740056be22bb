import pytest

from invented import prose

LANGS = ("en", "de")


@pytest.fixture(scope="session")
def texts():
    """Plain, NULL, empty, blank, short, long and repeated texts, near copies and a shared passage."""
    base = prose(1, 120)
    near = base.replace("sta", "STA", 1)
    passage = prose(2, 130).replace("\n", " ")
    return [
        base, base, near, None, "", "  \n\t ", "one two", "one two three four five", prose(3, 60) + "\n" + passage,
        prose(4, 70) + "\n" + passage + "\n" + prose(5, 40), prose(6, 4000), "Ünï çödé — 日本語 😀 don't 3.14 it's",
        "ab " * 300, "x" * 5000, "Home | About | News | Contact | Help\n" * 3 + prose(7, 90), prose(8, 30), prose(9, 52),
        "a\x00b \x1f c▁d   e", *[prose(20 + k, 80) for k in range(12)],
    ]


@pytest.fixture(scope="session")
def documents(spark, texts):
    """The texts as documents; the last two rows are one row twice, and one key is NULL."""
    rows = [(k, t, LANGS[k % 2], f"src{k % 3}", None if t is None else len(t)) for k, t in enumerate(texts)]
    rows += [(500, texts[-1], "en", "src1", 9), (500, texts[-1], "en", "src1", 9), (None, prose(99, 70), None, None, None)]
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    return spark.createDataFrame(rows, schema)


@pytest.fixture
def no_documents(documents):
    return documents.where("false")


@pytest.fixture
def word_file():
    from tallyframe.llm.queries import tokenizer_file

    return tokenizer_file()
