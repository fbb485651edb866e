import os

from strata.sources.files import (
    read_passengers, read_predictions, read_sales, read_scoring_set, write_predictions,
)


def test_sales_csv(spark, tmpdir_path):
    p = os.path.join(tmpdir_path, "sales.csv")
    with open(p, "w") as f:
        f.write("date,region,country,customer_id,delivery_type,revenue,cost,duration,cost_type\n")
        f.write("2019-01-01,E,A,1,fast,1000,400,60,expert\n")
        f.write("2019-03-05,,A,,fastest,2000,900,60,normal\n")
    df = read_sales(spark, p)
    rows = df.collect()
    assert dict(df.dtypes)["duration"] == "string"
    assert rows[0].duration == "60" and rows[1].region is None and rows[1].customer_id is None
    assert str(rows[0].date) == "2019-01-01 00:00:00"


def test_passenger_csv_and_predictions(spark, tmpdir_path):
    p = os.path.join(tmpdir_path, "train.csv")
    with open(p, "w") as f:
        f.write("PassengerId,Survived,Pclass,Name,Sex,Age,SibSp,Parch,Ticket,Fare,Cabin,Embarked\n")
        f.write('1,0,3,"Braund, Mr. Owen",male,22,1,0,A/5,7.25,,S\n')
        f.write('2,1,1,"Cumings, Mrs. John",female,,1,0,PC,71.25,C85,C\n')
    df = read_passengers(spark, p)
    rows = {r.passenger_id: r for r in df.collect()}
    assert rows[1].name == "Braund, Mr. Owen" and rows[1].cabin is None
    assert rows[2].age is None and rows[2].fare == 71.25
    t = os.path.join(tmpdir_path, "test.csv")
    with open(t, "w") as f:
        f.write("PassengerId,Pclass,Name,Sex,Age,SibSp,Parch,Ticket,Fare,Cabin,Embarked\n")
        f.write('892,3,"Kelly, Mr. James",male,34.5,0,0,330911,,,Q\n')
    s = read_scoring_set(spark, t).collect()[0]
    assert s.passenger_id == 892 and s.fare is None
    out = os.path.join(tmpdir_path, "pred")
    write_predictions(df.selectExpr("passenger_id", "survived AS prediction"), out)
    back = sorted(tuple(r) for r in read_predictions(spark, out).collect())
    assert back == [(1, 0), (2, 1)]


def test_period_includes_whole_end_day(spark, tmpdir_path):
    from pyspark.sql import functions as F

    from strata.functions.scalars import in_period
    p = os.path.join(tmpdir_path, "sales_t.csv")
    with open(p, "w") as f:
        f.write("date,region,country,customer_id,delivery_type,revenue,cost,duration,cost_type\n")
        f.write("2019-06-30 12:00:00,E,A,1,fast,10,4,60,expert\n")
        f.write("2019-07-01 00:00:00,E,A,1,fast,10,4,60,expert\n")
        f.write("2018-12-31 23:59:59,E,A,1,fast,10,4,60,expert\n")
    df = read_sales(spark, p)
    got = [r.inside for r in df.orderBy("date").select(
        in_period(F.col("date"), "2019-01-01", "2019-06-30").alias("inside")).collect()]
    assert got == [False, True, False]


def test_columns_go_by_name(spark, tmpdir_path):
    import pytest
    p = os.path.join(tmpdir_path, "permuted.csv")
    with open(p, "w") as f:
        f.write("date,country,extra,region,cost_type,customer_id,delivery_type,revenue,cost,duration\n")
        f.write("2019-01-01,A,z,E,expert,1,fast,1000,400,60\n")
    r = read_sales(spark, p).collect()[0]
    assert (r.region, r.country, r.customer_id, r.cost_type, r.duration) == ("E", "A", 1, "expert", "60")
    for reader, label in ((read_passengers, ["Survived"]), (read_scoring_set, [])):
        names = ["Embarked", "Name", "Sex", "Age", "PassengerId", "SibSp", "Parch", "Ticket", "Cabin", "Fare", "Pclass", *label]
        q = os.path.join(tmpdir_path, f"{reader.__name__}.csv")
        with open(q, "w") as f:
            f.write(",".join(names) + "\n" + ",".join(["S", "N", "male", "22", "7", "1", "0", "T", "", "7.25", "3", *["1" for _ in label]]) + "\n")
        r = reader(spark, q).collect()[0]
        assert (r.passenger_id, r.pclass, r.fare, r.embarked, r.cabin) == (7, 3, 7.25, "S", None)
    with open(p, "w") as f:
        f.write("date,country\n2019-01-01,A\n")
    with pytest.raises(ValueError, match="region"):
        read_sales(spark, p)
