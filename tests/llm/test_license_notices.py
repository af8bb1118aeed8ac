"""License notices and passages from the middle and end of license texts."""

import os
import sys

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pagetide.llm import license_texts, licenses  # noqa: E402


def test_notices_and_later_passages(spark):
    body = license_texts.TEXTS
    end = lambda name: " ".join(body[name].split()[-400:-100])
    texts = [
        ("Some prose of mine. Licensed under CC BY-NC 4.0.", {"cc"}),
        ("See https://creativecommons.org/licenses/by-sa/3.0/ for it.", {"cc"}),
        ("This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 License", {"cc"}),
        ("THE SOFTWARE IS PROVIDED \"AS IS\", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED "
         "TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE "
         "AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY", {"mit"}),
        (end("apache-2.0"), {"apache"}),
        (end("mpl-2.0"), {"mpl"}),
        (body["gpl-3"], {"gpl"}),
        (body["gpl-2"], {"gpl"}),
        ("under the general terms of a license by nobody, version 4.0, all of it common", set()),
    ]
    docs = spark.createDataFrame([(k, t) for k, (t, _) in enumerate(texts)], "doc_id int, text string")
    found = {r["id"]: {s["template"].split("-")[0] for s in r["spans"]} for r in licenses.scan(docs).collect()}
    assert found == {k: labels for k, (_, labels) in enumerate(texts)}
    assert sum(len(t.split()) for t in licenses.TEMPLATES.values()) <= licenses.MAX_GRAMS
