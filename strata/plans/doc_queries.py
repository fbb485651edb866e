"""The same feature pipeline and classifier on a second labelled table:
``documents`` joined to ``labels`` (quality ~ language, source, length)."""

from __future__ import annotations

from pyspark.sql import functions as F

from strata.operators import evaluate as ev
from strata.operators import models as M
from strata.operators.features import FeaturePipeline, FeatureSpec
from strata.operators.split import split_train_test
from strata.plans.registry import query
from strata.sources.tables import documents_labelled

DOC_SPEC = FeatureSpec(steps=(("scale", ("n_chars",)), ("one_hot", ("lang", "source"))))

DOCS_SQL = """
WITH docs AS (SELECT d.doc_id, d.lang, d.source, d.n_chars, l.quality
              FROM documents d JOIN labels l ON d.doc_id = l.doc_id),
split AS (SELECT *, substr(md5('42:' || CAST(doc_id AS VARCHAR)), 1, 12) < 'cccccccccccc' AS is_train
          FROM docs),
train AS (SELECT * FROM split WHERE is_train),
p AS (SELECT min(n_chars) AS mn, max(n_chars) AS mx FROM train)
"""


def doc_split(spark, sf_dir):
    return split_train_test(documents_labelled(spark, sf_dir), "doc_id")


def doc_features(spark, sf_dir):
    train, test = doc_split(spark, sf_dir)
    model = FeaturePipeline(DOC_SPEC, handle_unknown="ignore").fit(train)
    keep = ("doc_id", "quality")
    return model.transform(train, keep), model.transform(test, keep), model


@query("doc_features_long", DOCS_SQL + """
SELECT doc_id, 'n_chars' AS feature,
       (CAST(n_chars AS DOUBLE) - CAST(mn AS DOUBLE))
       / CAST(CASE WHEN mx = mn THEN 1 ELSE mx - mn END AS DOUBLE) AS value
FROM train, p
UNION ALL SELECT doc_id, 'lang_' || lang, CAST(1.0 AS DOUBLE) FROM train
UNION ALL SELECT doc_id, 'source_' || source, CAST(1.0 AS DOUBLE) FROM train
""")
def q_doc_features_long(spark, sf_dir):
    """Fitted document features of the training rows, long form (non-zero
    one-hot entries and the scaled length)."""
    train_f, _, model = doc_features(spark, sf_dir)
    names = model.feature_names
    long = train_f.unpivot(["doc_id"], names, "feature", "value")
    return long.where((F.col("feature") == "n_chars") | (F.col("value") != 0.0))


@query("doc_quality_logreg")
def q_doc_quality_logreg(spark, sf_dir):
    """Balanced logistic regression of document quality, fitted on the
    training documents and scored on the held-out ones."""
    train_f, test_f, model = doc_features(spark, sf_dir)
    names = model.feature_names
    m = M.fit_logreg(train_f, names, "quality", C=1.0, balanced=True)
    pred = M.predict(m, test_f, names, ["doc_id", "quality"])
    return ev.classification_metrics(pred, "quality")
