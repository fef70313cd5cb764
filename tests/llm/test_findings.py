"""Texts and tables on which the operators once did less than the whole job."""

from __future__ import annotations

import json
import random
import zlib

import duckdb
import numpy as np
import public_tokenizers
from tokenizers import Tokenizer

from tasteloom.llm import licenses, lines, oracles, packing, queries

WRAPPED = [
    "/* This program is free software: you can redistribute it and/or modify\n"
    " * it under the terms of the GNU General Public License as published by\n * the Free Software Foundation */",
    "Redistribution and use in source and binary forms, with or without\r\nmodification, are permitted provided",
    "Released\nunder\n\nthe\nMIT\nLicense",
]


def license_labels(spark, texts, **parameters):
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    found = licenses.scan(docs, **parameters).collect()
    return {r["doc_id"]: {f["label"]: f["containment"] for f in r["found"]} for r in found}


def test_license_notices_over_several_lines(spark):
    # At any place of a long text, so that no window begins with the notice.
    texts = WRAPPED + ["filler " * n + WRAPPED[0] + " filler" * 40 for n in range(25)]
    found = license_labels(spark, texts)
    assert found[0] == {"gpl-program": 1.0} and found[1] == {"bsd": 1.0} and found[2] == {"mit": 1.0}
    assert all(found[i] == {"gpl-program": 1.0} for i in range(3, len(texts)))


def test_license_words_far_apart_in_one_line_are_no_notice(spark):
    far = (" filler" * 100).join([" released", " under", " the", " mit", " license"])
    near = "filler " * 997 + "released under the MIT license" + " filler" * 1_000
    assert license_labels(spark, [far, near]) == {0: {}, 1: {"mit": 1.0}}


OTHERS = [
    "Released under the Apache License.", "the report was released under the new license", "licensed under CC BY 4.0",
    "licensed under CC BY ND 4.0", "licensed under the GNU license version 2.0",
    "This Source Code Form is subject to the terms of the Eclipse Public License",
    "This work is licensed under a Creative Commons license", "this program is free software you can redistribute it and "
    "or modify it under the terms of the apache license",
]
NOTICES = {
    "apache-2.0": 'Licensed under the Apache License, Version 2.0 (the "License");',
    "mit": "Released under the MIT License.",
    "mit-grant": "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated",
    "gpl-notice": "This work is licensed under the GNU General Public License version 3.",
    "gpl-program": "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General "
    "Public License as published by the Free Software Foundation",
    "bsd": "Redistribution and use in source and binary forms, with or without modification, are permitted provided that",
    "mpl-2.0": "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
    "cc-notice": "This work is licensed under a Creative Commons Attribution 4.0 International License.",
    "cc-by-nc": "Licensed under CC BY-NC 4.0",
}


def test_no_label_without_the_word_that_names_the_license(spark):
    assert license_labels(spark, OTHERS) == {i: {} for i in range(len(OTHERS))}


def wrapped(text, width):
    words = text.split(" ")
    return " ".join(w + "\n# " * (i % width == width - 1) for i, w in enumerate(words))


def test_notices_of_all_kinds_are_found_however_wrapped(spark):
    texts = [t for notice in NOTICES.values() for t in (notice, notice.upper(), wrapped(notice, 3), "x " * 50 + wrapped(notice, 7) + " y" * 90)]
    found = license_labels(spark, texts)
    for i, label in enumerate(NOTICES):
        assert all(label in found[4 * i + k] for k in range(4)), label
        assert all(set(found[4 * i + k]) == set(found[4 * i]) for k in range(4)), label


def test_license_sql_says_what_the_scan_does(spark, tmp_path):
    """On wrapped notices, CRLF ends, notices at any place, and words strewn over a long line."""
    draw = random.Random(4)
    texts = [None, "", *OTHERS, *WRAPPED, *NOTICES.values(), *(wrapped(t, 4).replace("\n", "\r\n") for t in NOTICES.values())]
    texts += [" ".join(["far"] * draw.randint(0, 70) + [t] + ["off"] * draw.randint(0, 70)) for t in NOTICES.values() for _ in range(4)]
    texts += [(" filler" * draw.randint(0, 5)).join(t.split(" ")) for t in NOTICES.values() for _ in range(4)]
    spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").coalesce(1).write.parquet(f"{tmp_path}/documents.parquet")
    con = duckdb.connect()
    con.execute(f"create view documents as select * from '{tmp_path}/documents.parquet/*.parquet'")
    expected = con.execute(oracles.ORACLE["op1_license_scan"]).fetchall()
    names = [c[0] for c in con.description]
    found = [tuple(r[c] for c in names) for r in queries.op1_license_scan(spark, str(tmp_path)).collect()]
    assert sorted(found) == sorted(expected) and len({r[names.index("labels")] for r in found}) > 9


def test_added_tokens_keep_their_ids(spark):
    path = public_tokenizers.path(queries.TOKENIZER)
    own = Tokenizer.from_file(path)
    assert own.encode("one <|endoftext|> two", add_special_tokens=False).ids == [505, 220, 50256, 734]
    draw = random.Random(7)
    parts = ["a", "it's", " ", " ", "\n", "\t", "é", "<|endoftext|>", "<|endoftext|>", "<|", "|>", "endoftext", "字", "\r\n", "1", "!"]
    texts = ["one <|endoftext|> two", "<|endoftext|>"] + ["".join(draw.choices(parts, k=draw.randint(1, 14))) for _ in range(3_000)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    found = {r["doc_id"]: (r["length"], r["ids_crc32"]) for r in packing.pieces(docs, path).collect()}
    for i, text in enumerate(texts):
        ids = [*own.encode(text, add_special_tokens=False).ids, 0]
        assert found[i] == (len(ids), zlib.crc32(np.array(ids, dtype="<u4").tobytes()))


def test_added_tokens_that_take_in_white_space(tmp_path):
    with open(public_tokenizers.path(queries.TOKENIZER), encoding="utf-8") as f:
        described = json.load(f)
    described["added_tokens"][0]["lstrip"] = True
    path = tmp_path / "tokenizer.json"
    path.write_text(json.dumps(described))
    ids = Tokenizer.from_file(str(path)).encode("one  <|endoftext|> two", add_special_tokens=False).ids
    made = packing._Tokens(str(path)).of("one  <|endoftext|> two")
    assert made == np.array(ids, dtype="<u4").tobytes()


def test_lines_with_mixed_ends_are_one_line(spark):
    ends = ["\r", "", "\t", " \x0b", "\x0c"]
    rows = [(i, f"own {i}\r\n\r\n\t\n \n{ends[i % 5]}cookie notice{ends[i % 5]}\nend {i}", f"site{i}") for i in range(12)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    found = {r["doc_id"]: (r["n_lines"], r["n_removed"], r["text"]) for r in lines.remove_lines(docs).collect()}
    assert found[0] == (6, 0, rows[0][1])
    assert all(found[i] == (6, 1, f"own {i}\r\n\r\n\t\n \nend {i}") for i in range(1, 12))
