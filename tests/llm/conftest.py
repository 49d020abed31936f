import random

import pytest

DOC = "doc_id bigint, text string, lang string, source string, n_chars bigint, n_lines int, component_id string"


@pytest.fixture(scope="session")
def docs_of(spark):
    """Documents with clashing extra columns from (doc_id, text) or (doc_id, text, source)."""
    from marketlake.session import configure

    configure(spark)

    def make(rows):
        full = [(r[0], r[1], None, r[2] if len(r) > 2 else "s", None, 7, "x") for r in rows]
        return spark.createDataFrame(full, DOC)

    return make


@pytest.fixture(scope="session")
def prose():
    """Random text of n words."""
    generator = random.Random(3)
    words = ["".join(generator.choice("abcdefghijklmnop") for _ in range(generator.randint(2, 8))) for _ in range(400)]
    return lambda n: " ".join(generator.choice(words) for _ in range(n))
