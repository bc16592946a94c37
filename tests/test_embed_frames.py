"""Vectors leave the encoder's task in frames of many request batches."""

import pandas as pd

from civicspark.operators import enrich


class Rows:
    def mapInPandas(self, run, schema):
        return run


def test_a_frame_holds_many_batches():
    asked = []

    def encoder(texts):
        asked.append(len(texts))
        if "bad" in texts:
            raise RuntimeError("no")
        return [[float(len(t)), 1.0] for t in texts][:9 if "short" in texts else None], len(texts)

    texts = ["t"] * 200
    texts[25], texts[45] = "bad", "short"
    frame = pd.DataFrame({"proposicao_id": range(1000, 1200), "texto": texts}, index=range(7, 207))
    out = list(enrich.embed_texts(Rows(), encoder, batch_size=10)(iter([frame])))
    assert len(out) == 1 and asked == [10] * 20
    rows = out[0]
    assert rows["proposicao_id"].tolist() == list(range(1000, 1200))
    failed = [*range(20, 30), *range(40, 50)]
    assert [i for i, e in enumerate(rows["erro"]) if e is not None] == failed == [i for i, v in enumerate(rows["embedding"]) if v is None]
    assert rows["erro"].tolist()[20] == "no" and "does not match" in rows["erro"].tolist()[40]
    assert [i for i, n in enumerate(rows["tokens"]) if n] == [i for i in range(0, 200, 10) if i not in failed]
