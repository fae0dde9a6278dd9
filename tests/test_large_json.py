"""Documents read by byte ranges against the json module."""

import json
import random

import pytest

from tilewright.sources import large_json, results


def entry(rng, i):
    texts = ["plain", "a } brace", '{"quoted": "json"}', "back\\slash", 'quote " and \\" more', "]}[{", "\n\t", "北京 {中}", "\\", "x" * 300, "", "end\\\\"]
    e = {"dataset": "d", "sample_id": i, "original_prompt": rng.choice(texts), "model_answers": [rng.choice(texts) for _ in range(rng.randrange(3))], "scores": [1.0] * rng.randrange(3)}
    if rng.random() < 0.3:
        e["more"] = {"deep": [{"er": [rng.choice(texts)]}, {}], "n": None}
    return e


def want(documents):
    out = []
    for document in documents:
        if isinstance(document, list):
            out += [(None, e) for e in document]
        else:
            out += [(m, e) for m, v in document.items() for e in (v if isinstance(v, list) else [v])]
    return sorted((m or "", json.dumps(e, sort_keys=True)) for m, e in out)


@pytest.mark.parametrize("split", [17, 64, 257, 4096, 1 << 20])
@pytest.mark.parametrize("indent", [None, 2])
def test_entries_of_documents(spark, tmp_path, split, indent):
    rng = random.Random(split)
    documents = [
        {m: [entry(rng, i) for i in range(rng.randrange(9))] for m in ["A", "mo}del", 'q"uote{', "empty", "北]"]},
        [entry(rng, i) for i in range(12)],
        {"single": entry(rng, 1), "list": [entry(rng, 2)], "other": entry(rng, 3), "none": []},
        {}, [], {"A": []}, {"A": [{}], "B": [{}, {}]}, [{}],
    ]
    for k, document in enumerate(documents):
        (tmp_path / f"{k}.json").write_text(json.dumps(document, ensure_ascii=k % 2 == 0, indent=indent) + ("\n" if k % 3 else ""))
    found = large_json.read_entries(spark, str(tmp_path), split_bytes=split).collect()
    assert sorted((r.model or "", json.dumps(json.loads(r.entry), sort_keys=True)) for r in found) == want(documents)


def test_large_and_small_documents_give_the_same(spark, tmp_path):
    rng = random.Random(1)
    (tmp_path / "map.json").write_text(json.dumps({m: [entry(rng, i) for i in range(40)] for m in "ABC"}))
    (tmp_path / "list.json").write_text(json.dumps([entry(rng, i) | {"model_name": "L"} for i in range(40)], indent=1))
    (tmp_path / "small.json").write_text(json.dumps({"S": [entry(rng, 1)]}))
    rows = lambda df: sorted(map(str, df.collect()))
    whole = rows(results.read_results(spark, str(tmp_path)))
    assert len(whole) == 161
    assert rows(results.read_results(spark, str(tmp_path), whole_bytes=2000, split_bytes=500)) == whole
    assert rows(results.read_results(spark, str(tmp_path), whole_bytes=0)) == whole
