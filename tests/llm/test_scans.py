"""Secrets, licences, decontamination and PII against plain versions."""

import hashlib
import itertools
import random
import re
import string
import textwrap
import uuid
from collections import Counter

from pyspark.sql import functions as F

from retailcast.llm import decontam, license_dice, secret_ledger, surrogates
from retailcast.session import shared_path
from tests.conftest import SF0001
from tests.llm.conftest import frame

ASSIGN = r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""


def base_spans(text):
    text = text or ""
    out = [(m.start(), 0, m.end(), "assign") for m in re.finditer(ASSIGN, text, re.I | re.A) if len(m[2]) >= 6]
    out += [(m.start(), 1, m.end(), "access") for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 20]
    out += [(m.start(), 2, m.end(), "hex") for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 24]
    return [(k, s, e) for s, _, e, k in sorted(out)]


def ledger(spark):
    return shared_path(spark, f"tables/test-ledger-{uuid.uuid4().hex}")


SECRETS = ["pässword PASSWORD = 'abcdef1' x", "token=abc secret: ab_c.d-e= api_key=\"0123456789abcdef0123456789abcdef\"", "AKIA" + "Z9" * 9 + " AKIAshort",
           "f" * 23 + " " + "0a" * 12, "ſecret=abcdefg Key", "https://u:pw@h ghp_" + "a1" * 20, "-----BEGIN RSA PRIVATE KEY-----\nAAAA" + "B" * 40 + "\n-----END RSA PRIVATE KEY-----", None, ""]


def test_secrets_match_plain(spark):
    docs = spark.read.parquet(f"{SF0001}/documents.parquet").select("doc_id", "text").unionByName(
        frame(spark, SECRETS).withColumn("doc_id", F.col("doc_id") + 10**6))
    texts = {r["doc_id"]: r["text"] for r in docs.collect()}
    rows = secret_ledger.secret_report(secret_ledger.secrets(docs, ledger(spark))).collect()
    assert len(rows) == len(texts)
    for r in rows:
        spans = base_spans(texts[r["doc_id"]])
        n, text = Counter(k for k, _, _ in spans), ",".join(f"{k}:{s}:{e}" for k, s, e in spans)
        assert (r["n_assign"], r["n_access"], r["n_hex"], r["base_sha256"]) == (n["assign"], n["access"], n["hex"], hashlib.sha256(text.encode()).hexdigest())
        assert set(text.split(",")) - {""} <= set(r["spans"].split(","))
    more = {x.split(":")[0] for r in rows for x in r["spans"].split(",")}
    assert {"pem", "github", "basic_auth"} <= more


def test_ledger_scans_only_what_is_new(spark, no_docs):
    path, one = ledger(spark), frame(spark, ["token=abcdef1", "x", "x"])
    assert secret_ledger.update_ledger(one, path).count() == 2          # two blobs for three paths
    assert secret_ledger.update_ledger(one, path).count() == 0
    more = frame(spark, ["token=abcdef1", "x", "x", "new password=abcdefg"])
    assert secret_ledger.update_ledger(more, path).count() == 1
    assert secret_ledger.update_ledger(more, path, secret_ledger.BASE_RULES).count() == 3      # another rule version
    found = secret_ledger.secret_report(secret_ledger.secrets(more, path)).orderBy("doc_id").collect()
    assert [r["n_assign"] for r in found] == [1, 0, 0, 1]
    assert secret_ledger.secrets(no_docs, ledger(spark)).count() == 0


def test_secrets_odd_rows(odd_docs, spark):
    assert secret_ledger.secrets(odd_docs, ledger(spark)).count() == odd_docs.count()


def plain_licences(text, table, least=license_dice.THRESHOLD):
    """Every window of every template's size, with Python strings."""
    norm = lambda t: re.findall(r"[a-z0-9\u0080-\U0010ffff]+(?:(?<=[0-9])\.(?=[0-9])[a-z0-9\u0080-\U0010ffff]+)*", re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))
    bag = lambda w: Counter(itertools.pairwise(w))
    words, found = norm(text), []
    for x in table:
        own = norm(x.text)
        n = min(len(own), len(words))
        for s in range(len(words) - n + 1 if n > 1 else 0):
            window = words[s:s + n]
            score = 2 * sum((bag(window) & bag(own)).values()) / (n + len(own) - 2)
            line = f" {' '.join(window)} "
            holds = lambda part: f" {' '.join(norm(part))} " in line  # noqa: B023, E731
            if score >= least and all(any(map(holds, m)) for m in x.must) and not any(map(holds, x.never)):
                found.append((-score, -n, s, x.license))
    best, taken = {}, []
    for score, n, s, name in sorted(found):
        if not any(s < e and f < s - n and other != name for f, e, other in taken):
            taken.append((s, s - n, name))
            best.setdefault(name, (-score, s, -n))
    return best


def test_licences_match_brute_force(spark):
    table = license_dice.templates()[::9] + license_dice.templates()[:16]
    rng, texts = random.Random(4), ["plain text of no kind", None, "", "a", "the the the", "mit mit mit license"]
    for t in table:
        words = t.text.split()
        for _ in range(rng.randrange(2)):
            words[rng.randrange(len(words))] = rng.choice(["changed", "", "two words"])
        texts.append("before it " + "\n".join(words) + rng.choice([" after it", "", " and the MIT License"]))
    got = {}
    for r in license_dice.license_scan(frame(spark, texts), table=table).collect():
        got.setdefault(r["doc_id"], {})[r["license"]] = (r["dice"], r["first_word"], r["n_words"])
    for i, text in enumerate(texts):
        want = plain_licences(text, table)
        # of windows with the same Dice, only those aligned to a shared bigram are seen
        assert {k: round(v[0], 9) for k, v in got.get(i, {}).items()} == {k: round(v[0], 9) for k, v in want.items()}, text


BSD_TEXT = """Copyright (c) 1998, 2001 The Regents of the Example University. All rights reserved.

Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:

 * Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer.
 * Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the
   documentation and/or other materials provided with the distribution.
{}
THIS SOFTWARE IS PROVIDED BY THE REGENTS AND CONTRIBUTORS ``AS IS'' AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE
IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE REGENTS OR CONTRIBUTORS BE
LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE
GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT,
STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE
POSSIBILITY OF SUCH DAMAGE."""
ENDORSE = " * Neither the name of the University nor the names of its contributors may be used to endorse or promote products derived from this software\n   without specific prior written permission.\n"
GPL_3 = """                    GNU GENERAL PUBLIC LICENSE
                       Version 3, 29 June 2007

 Copyright (C) 2007 Free Software Foundation, Inc. <https://fsf.org/>
 Everyone is permitted to copy and distribute verbatim copies of this license document, but changing it is not allowed.

                            Preamble

  The GNU General Public License is a free, copyleft license for software and other kinds of works."""
GPL_1 = """                    GNU GENERAL PUBLIC LICENSE
                     Version 1, February 1989

 Copyright (C) 1989 Free Software Foundation, Inc. 51 Franklin St, Fifth Floor, Boston, MA 02110-1301 USA
 Everyone is permitted to copy and distribute verbatim copies of this license document, but changing it is not allowed."""
GPL_NOTICE = """foo.c - frobnicates. Copyright 2011 Jane Doe

This program is free software{} you can redistribute it and/or modify it under the terms of the GNU {}General Public License as published by the Free
Software Foundation{} either version {} of the License, or (at your option) any later version. This program is distributed in the hope that it will be
useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE."""
APACHE = """                                 Apache License
                           Version 2.0, January 2004
                        http://www.apache.org/licenses/

   TERMS AND CONDITIONS FOR USE, REPRODUCTION, AND DISTRIBUTION

   1. Definitions."""
APACHE_HEADER = """Copyright 2019 The Frob Authors. Licensed under the Apache License, Version {} (the "License"); you may not use this file except in
compliance with the License. You may obtain a copy of the License at https://www.apache.org/licenses/LICENSE-{}. Unless required by applicable law"""
CC_CODE = """Creative Commons Attribution-ShareAlike {0} International Public License. By exercising the Licensed Rights (defined below), You accept and
agree to be bound by the terms and conditions of this Creative Commons Attribution-ShareAlike {0} International Public License ("Public License"). To the
extent this Public License may be interpreted as a contract"""


def test_licences_of_known_texts(spark):
    """Texts written apart from the templates, as found in files, and other versions."""
    cases = [("This project is licensed under the terms of the\nApache License, Version 2.0.", "Apache-2.0"), ("GNU General Public License, version 1", None),
             (BSD_TEXT.format(ENDORSE), "BSD-3-Clause"), (BSD_TEXT.format(""), "BSD-2-Clause"), (GPL_3, "GPL-3.0"), (GPL_1, None),
             (GPL_NOTICE.format(":", "", ",", 3), "GPL-3.0"), (GPL_NOTICE.format(";", "", ";", 2), "GPL-2.0"), (GPL_NOTICE.format(";", "", ";", 1), None),
             (GPL_NOTICE.format(":", "Affero ", ",", 3), "AGPL-3.0"), (GPL_NOTICE.format(":", "Lesser ", ",", "2.1"), "LGPL-2.1"), (APACHE, "Apache-2.0"),
             (APACHE_HEADER.format("2.0", "2.0"), "Apache-2.0"), (APACHE_HEADER.format("1.1", "1.1"), None), (CC_CODE.format("4.0"), "CC-BY-SA-4.0"),
             (CC_CODE.format("5.0"), None), ("# SPDX-License-Identifier: MIT", "MIT"), ("/* SPDX-License-Identifier: GPL-2.0-or-later */ int x;", "GPL-2.0"),
             ("// SPDX-License-Identifier: GPL-1.0", None), ("Released under the Apache License, Version 2.1.", None),
             ("This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License.", "CC-BY-NC-4.0"),
             ("We met at MIT and talked about the license of the software and its version 2.0 for hours.", None)]
    wrapped = [(t, w) for text, w in cases for t in (text, "\n".join(textwrap.wrap(text, 72)), "\n".join(" * " + x for x in textwrap.wrap(text, 72)))]
    found = {}
    for r in license_dice.license_scan(frame(spark, ["Some words in front.\n" + t + "\nMore words behind." for t, _ in wrapped])).collect():
        found.setdefault(r["doc_id"], []).append(r["license"])
    assert [found.get(i, []) for i in range(len(wrapped))] == [[w] if w else [] for _, w in wrapped]


def test_licences_odd_rows(odd_docs, no_docs):
    assert license_dice.license_scan(odd_docs).count() == 0 and license_dice.license_scan(no_docs).count() == 0


def windows_brute(docs, items, least=0.75):
    words = lambda t: re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))
    bag = lambda w: Counter(tuple(w[i:i + 5]) for i in range(max(1, len(w) - 4))) if w else Counter()
    out = {}
    for d, t in docs:
        w = words(t)
        for i, x in items:
            v = words(x)
            scores = []
            for s in range(max(1, len(w) - len(v) + 1)):
                a, b = bag(w[s:s + len(v)]), bag(v)
                if a and b:
                    scores.append((sum((a & b).values()) / sum((a | b).values()), -s))
            if scores and max(scores)[0] >= least:
                out[d, i] = (max(scores)[0], -max(scores)[1])
    return out


def test_decontamination_matches_brute_force(spark):
    docs = spark.read.parquet(f"{SF0001}/documents.parquet")
    items = spark.read.parquet(f"{SF0001}/benchmark.parquet")
    it = [(r["item_id"], r["text"]) for r in items.collect()]
    long = " ".join(f"q{i}" for i in range(60))
    it += [(1000, long), (1001, "tiny one"), (1002, None), (1003, "a b c d e a b c d e a b c d e a b")]
    edited = long.split()
    edited[0], edited[59] = "zz", "yy"
    extra = ["pre " + long + " post", "x " + " ".join(edited) + " y", " ".join(long.split()[:45]), "TINY one", "tiny one more", "a b c d e a b c d e a b c d e a b"]
    rows = [(r["doc_id"], r["text"]) for r in docs.collect() if len(r["text"]) < 4000] + [(10**6 + i, t) for i, t in enumerate(extra)]
    got = decontam.contaminated(spark.createDataFrame(rows, "doc_id long, text string"), spark.createDataFrame(it, "item_id long, text string")).collect()
    want = windows_brute(rows, it)
    assert {(r["doc_id"], r["item_id"]) for r in got} == set(want) and len(got) == len(want)
    for r in got:
        assert abs(r["similarity"] - want[r["doc_id"], r["item_id"]][0]) < 1e-12


def test_decontamination_odd_rows(spark, odd_docs, no_docs):
    items = frame(spark, ["one two three four"]).toDF("item_id", "text")
    got = decontam.contaminated(odd_docs, items).collect()
    assert sorted(r["doc_id"] for r in got) == [3, 5, 5][:0] + sorted(r["doc_id"] for r in odd_docs.collect() if (r["text"] or "").lower() == "one two three four")
    kept = decontam.decontaminate(odd_docs, items)
    assert kept.columns == odd_docs.columns and kept.count() == odd_docs.count() - 2
    assert decontam.contaminated(no_docs, items).count() == 0 and decontam.contaminated(odd_docs, items.limit(0)).count() == 0


PII = ["Mail Ann.B@ex-ample.com or ann.b@EX-ample.com, call +1 (555) 010-9999 / 555-010-9999; ip 10.0.0.7.",
       "card 4111111111111111 and 4111 1111 1111 1111, not 4111111111111112 here", "Mr. John Smith met Mrs. Mary Smith and Mr Smith. господин Иванов",
       "ssn 123-45-6789 and 123-45-6780", "version 2.0, 12 items, 3.14.15 none", "1.2.3.4 1.2.3.5 255.255.255.256", None, ""]


def test_surrogates(spark, odd_docs, no_docs):
    out = {r["doc_id"]: r for r in surrogates.replace_entities(frame(spark, PII), "k").collect()}
    assert out[0]["kinds"] == ["email", "email", "phone", "phone", "ip"] and out[2]["kinds"] == ["person"] * 4
    mails = re.findall(r"\S+@\S+?\.com", out[0]["text"])
    assert mails[0].lower() == mails[1].lower() and mails[0][0].isupper() and mails[0] != mails[1] and "ann.b" not in out[0]["text"].lower()
    assert re.search(r"\+1 \(\d{3}\) \d{3}-\d{4} / \d{3}-\d{3}-\d{4};", out[0]["text"])
    cards = re.findall(r"\d[\d ]{14,}\d", out[1]["text"])
    assert cards[0] == cards[1].replace(" ", "") and cards[2] != cards[0] and cards[0][0] == "4"
    luhn = lambda s: sum(sum(divmod(int(c) * (1 + i % 2), 10)) for i, c in enumerate(reversed(s))) % 10 == 0
    assert luhn(cards[0])
    names = re.findall(r"(?:Mr\.?|Mrs\.) ((?:\w+ )?\w+)", out[2]["text"])
    assert names[0].split()[1] == names[1].split()[1] == names[2] != "Smith" and names[0].split()[0] != names[1].split()[0]
    assert re.search(r"господин [а-яА-Я]+$", out[2]["text"]) and "Иванов" not in out[2]["text"]
    ssn = re.findall(r"\d{3}-\d{2}-\d{4}", out[3]["text"])
    assert len(set(ssn)) == 2 and not {"123-45-6789", "123-45-6780"} & set(ssn)
    assert out[4]["text"] == PII[4] and out[5]["kinds"] == ["ip", "ip"] and "255.255.255.256" in out[5]["text"]
    assert out[6]["text"] is None and out[7]["text"] == "" and out[6]["n_entities"] == 0
    again = {r["doc_id"]: r["text"] for r in surrogates.replace_entities(frame(spark, PII), "k").collect()}
    other = {r["doc_id"]: r["text"] for r in surrogates.replace_entities(frame(spark, PII), "another key").collect()}
    assert again == {i: r["text"] for i, r in out.items()} and other[0] != again[0]
    assert surrogates.replace_entities(odd_docs, "k").count() == odd_docs.count() and surrogates.replace_entities(no_docs, "k").count() == 0


def test_surrogates_stay_distinct_when_draws_collide(spark):
    """Two-digit hosts leave few draws: the redraws must keep all replacements apart and off real values."""
    texts = [f"host 1.1.1.{i}" for i in range(10)]
    got = [r["text"].split()[1] for r in surrogates.replace_entities(frame(spark, texts), "k").collect()]
    assert len(set(got)) == 10 and not set(got) & {f"1.1.1.{i}" for i in range(10)}


SAMPLES = {"phone": ["1-800-555-1234", "555.123.4567", "555 123 4567", "+14155550123", "1 415 555 0123", "1 (415) 555-0123", "(415) 555 0123", "+49 151 12345678", "+12 34 56"],
           "card": ["-".join("4111111111111111"), "4111 1111 1111 1111", " ".join("4111111111111")], "ssn": ["123-45-6789"], "ip": ["1.2.3.4"], "email": ["a@b.org"],
           "person": ["Dr Smith", "Prof. Dr. Anna Müller", "Sra. García", "Mr. John Smith"]}


def test_surrogates_find_common_forms(spark):
    flat = [(k, x) for k, xs in SAMPLES.items() for x in xs]
    got = [r.asDict() for r in surrogates.replace_entities(frame(spark, [f"see {x}, then" for _, x in flat]), "k").orderBy("doc_id").collect()]
    assert [g["kinds"] for g in got] == [[k] for k, _ in flat]
    shape = lambda t: re.sub("[0-9]", "9", t)
    for g, (kind, x) in zip(got, flat, strict=True):
        assert x not in g["text"]
        assert kind not in ("phone", "card") or shape(g["text"]) == shape(f"see {x}, then")
    new = {x: re.sub("[^0-9]", "", g["text"]) for g, (_, x) in zip(got, flat, strict=True)}
    assert new["+14155550123"] == new["1 415 555 0123"] == new["1 (415) 555-0123"]
    assert [g["text"].split()[1:3] for g, (_, x) in zip(got, flat, strict=True) if x.startswith("Prof")] == [["Prof.", "Dr."]]
    hint = frame(spark, [x for _, x in flat]).select(F.col("text").rlike(surrogates.HINT).alias("h")).collect()
    assert all(r["h"] for r in hint)


def test_surrogates_never_run_out(spark):
    """More surnames and given names than short draws, every one-letter local part of a domain, all short hosts and phones."""
    names = ["".join(x).capitalize() for x in itertools.islice(itertools.product("bcdfgklmnprstvz", "aeiou", "xzvtr", "aeiou", "lmnr"), 5000)]
    mails = [f"{c}@one.org" for c in string.ascii_lowercase + string.digits]
    texts = ([f"Mr. {n} {n}" for n in names] + mails + [f"{c.upper()}@One.org" for c in "abc"]
             + [f"host 1.1.{i // 100}.{i % 100}" for i in range(1000)] + [f"call +1 {i // 100 + 10} {i % 100:02d}" for i in range(6000)])
    got = [r["text"] for r in surrogates.replace_entities(frame(spark, texts), "k").orderBy("doc_id").collect()]
    assert {len(x.split()) for x in got[:5000]} == {3}
    assert len({x.split()[1] for x in got[:5000]}) == len({x.split()[2] for x in got[:5000]}) == 5000
    new = got[5000:5000 + len(mails)]
    assert len(set(new)) == len(mails) and not set(new) & set(mails) and len({m.split("@")[1] for m in new}) == 1
    assert all(re.fullmatch(r"[a-z0-9][a-z]*@[a-z]{3}\.org", m) for m in new)
    assert [m.lower() for m in got[5000 + len(mails):5003 + len(mails)]] == new[:3] and got[5000 + len(mails)][0].isupper()
    for part in (got[5003 + len(mails):6003 + len(mails)], got[6003 + len(mails):]):
        assert len(set(part)) == len(part) and not set(part) & set(texts)


def test_surrogates_have_no_python(spark):
    plan = surrogates.replace_entities(frame(spark, PII), "k")._jdf.queryExecution().optimizedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan
