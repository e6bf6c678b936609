"""The language stage keeps what a learned language claims, however it differs from the texts that were learned."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pytest

from quarterlens.llm import language

ORDINARY = [
    "The committee will meet again on Thursday to discuss the new budget.",
    "Our train was late because of the heavy snow in the mountains.",
    "Please remember to switch off the lights before you leave the office.",
    "She opened the window and looked out at the quiet street below.",
    "Die Kinder spielen heute im Garten hinter dem alten Haus.",
    "Wir haben gestern Abend lange über das neue Gesetz gesprochen.",
    "Der Zug nach Berlin fährt in zehn Minuten von Gleis vier ab.",
    "El gobierno anunció ayer una nueva ley sobre las pensiones.",
    "Mi hermana vive en una casa pequeña cerca del mar.",
    "Le président a déclaré hier que la loi serait votée demain.",
    "Nous avons passé nos vacances dans un petit village de montagne.",
    "def main(argv): return sum(int(x) for x in argv)",
    "Breaking news", "Recipe for apple pie", "De.", "a", "Haus", "¿Qué?",
]
FOREIGN = [
    "Il presidente della repubblica ha dichiarato che ieri il governo ha approvato una nuova legge sulle pensioni",
    "Presidentti sanoi eilen että hallitus on hyväksynyt uuden lain kaikkien työntekijöiden eläkkeistä maassa",
    "Президент заявил вчера что правительство приняло новый закон о пенсиях для всех работников страны",
    "总统昨天表示政府通过了一项关于全国所有员工养老金的新法律",
    "xqzv kjwp zzrt bvxq wqpl jkxz qqvt hjkl zxcv mnbq wrtp plkj xqwz vbnm jjqx",
]


@pytest.fixture(scope="module")
def model(spark):
    return language.train(spark.read.parquet("/root/testdata/sf0.1/documents.parquet"))


def claims(spark, model, texts):
    return language.scorer(spark, model)()(pa.array([t.lower() for t in texts]))[2].tolist()


def test_ordinary_texts_stay_and_foreign_ones_go(spark, model):
    assert [t for t, c in zip(ORDINARY, claims(spark, model, ORDINARY)) if not c] == []
    assert [t for t, c in zip(FOREIGN, claims(spark, model, FOREIGN)) if c] == []


def test_the_bounds_come_from_held_out_fragments(model):
    """The same bounds by plain kernels and a fit of one's own for each fold."""
    landmarks, languages, _, least_score, least_share = model
    assert len(languages) == 4 and 0.2 < least_score < 0.5 and 0.3 < least_share < 0.5
    rng = np.random.default_rng(1)
    known = [np.sort(rng.choice(5000, 300, replace=False)).astype(np.int32) for _ in range(12)]
    kernel = language.Kernel(known[:4])
    plain = lambda sets: np.array([[len(set(s) & set(m)) / np.sqrt(len(m)) / np.sqrt(max(
        len(set(s) & set(np.concatenate(known[:4]))), 1)) for m in known[:4]] for s in sets])
    assert np.allclose(kernel.of_sets(known), plain(known), atol=1e-6)
    labels = np.array(list("aabb" "abab" "abab"), dtype=object)
    folds = np.array([-1] * 4 + [0, 0, 1, 1] * 2)
    pieces = [s[::2] for s in known[4:]]
    got = language.calibrate(kernel, plain(known[:4]), plain(known), labels, folds, pieces, labels[4:], folds[4:])
    own, others = [], []
    for fold in (0, 1):
        names, coefficients = language.fit(plain(known)[folds != fold], labels[folds != fold], plain(known[:4]))
        for s, label in [(s, x) for s, x, f in zip(pieces, labels[4:], folds[4:]) if f == fold]:
            for name, score in zip(names, (plain([s])[0] @ coefficients + 1) / 2):
                (own if name == label else others).append(score)
    gaps = [abs(np.mean(np.array(own) < x) - np.mean(np.array(others) >= x)) for x in own + others]
    here = abs(np.mean(np.array(own) < got[0] - 1e-9) - np.mean(np.array(others) >= got[0] - 1e-9))
    assert np.isclose(here, min(gaps)) and any(np.isclose(got[0], x) for x in own + others)
    share = [np.isin(s, np.concatenate(known[:4])).mean() for s in pieces]
    assert np.isclose(got[1], language.LEAST_SHARE * np.quantile(share, language.TAIL))
    nothing = language.calibrate(kernel, plain(known[:4]), plain(known), labels, folds, [], np.array([]), np.array([]))
    assert nothing == (0.0, 0.0)
