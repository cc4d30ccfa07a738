"""Small transaction frames for tests."""

SCHEMA = ("TransactionID bigint, isFraud int, TransactionDT bigint, TransactionAmt double, ProductCD string, card1 bigint, "
          "addr1 double, P_emaildomain string, C1 double, D1 double, V1 double, M1 string, M4 string")
BASE = dict(TransactionID=1, isFraud=0, TransactionDT=90061, TransactionAmt=99.0, ProductCD="W", card1=1001, addr1=200.0,
            P_emaildomain="gmail.com", C1=1.0, D1=2.0, V1=3.0, M1="T", M4="M0")


def row(**changes):
    return {**BASE, **changes}


def frame(spark, *rows):
    names = [part.split()[0] for part in SCHEMA.split(", ")]
    return spark.createDataFrame([tuple(r[n] for n in names) for r in rows], SCHEMA)


def by_id(df):
    return {r.TransactionID: r for r in df.collect()}
