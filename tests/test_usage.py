"""The README usage flow, run end to end on small CSV files."""

import os

from fixtures import PASSENGER_ROWS, SALES_ROWS


def _write_csvs(d):
    with open(os.path.join(d, "sales.csv"), "w") as f:
        f.write("date,region,country,customer_id,delivery_type,revenue,cost,duration,cost_type\n")
        for r in SALES_ROWS:
            reg, cty, cid, date, dl, rev, cost, ct, dur = r
            f.write(f"{date},{reg or ''},{cty},{cid},{dl},{rev},{cost},{dur},{ct}\n")
    head = "PassengerId,Survived,Pclass,Name,Sex,Age,SibSp,Parch,Ticket,Fare,Cabin,Embarked\n"
    with open(os.path.join(d, "train.csv"), "w") as f, \
            open(os.path.join(d, "test.csv"), "w") as g:
        f.write(head)
        g.write(head.replace("Survived,", ""))
        for pid, surv, pc, name, sex, age, sib, par, fare, cabin, emb in PASSENGER_ROWS * 5:
            cells = [pc, f'"{name}"', sex, "" if age is None else age, sib, par, "T",
                     fare, cabin or "", emb or ""]
            f.write(",".join(map(str, [pid, surv] + cells)) + "\n")
            g.write(",".join(map(str, [pid + 1000] + cells)) + "\n")


def test_readme_flow(spark, tmpdir_path):
    _write_csvs(tmpdir_path)
    p = lambda name: os.path.join(tmpdir_path, name)

    # --- as in the README ---
    from strata.operators.rollup import Periods, sales_rollup
    from strata.sources import read_passengers, read_sales, read_scoring_set, write_predictions

    rollup = sales_rollup(read_sales(spark, p("sales.csv")), Periods())

    from strata.operators import evaluate as ev
    from strata.operators import models as M
    from strata.operators.enrich import enrich
    from strata.operators.features import FeaturePipeline, add_interactions

    labelled = enrich(read_passengers(spark, p("train.csv")))
    fm = FeaturePipeline().fit(labelled)
    feats = add_interactions(fm.transform(labelled))
    names = [c for c in feats.columns if c not in ("passenger_id", "survived")]
    lr = M.fit_logreg(feats, names, "survived", C=1.0, balanced=True)
    metrics = ev.classification_metrics(
        M.predict(lr, feats, names, ["passenger_id", "survived"]), "survived")
    scoring = add_interactions(fm.transform(enrich(read_scoring_set(spark, p("test.csv")))))
    write_predictions(M.predict(lr, scoring, names, ["passenger_id"]), p("predictions"))
    # ------------------------

    assert len(rollup.collect()) == 3
    assert metrics.first().accuracy > 0.5
    out = spark.read.option("header", True).csv(p("predictions"))
    assert out.columns == ["PassengerId", "Survived"] and out.count() == 40
