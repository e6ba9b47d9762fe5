import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from lexigrid.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = build_session("tests", spark__sql__shuffle__partitions="4")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def products(spark):
    rows = [
        (1, "Copper watering can", "tools", 62, 4.7, "2023-05-03 08:15:00", True),
        (2, "Tomato seeds", "seeds", 4, 4.1, "2023-05-19 17:40:00", True),
        (3, "Hand trowel", "tools", 18, 3.8, "2023-06-07 11:05:00", False),
        (4, "Basil seeds", "seeds", 3, 4.6, "2023-07-22 06:30:00", True),
        (5, "Steel rake", "tools", 41, 4.3, "2023-06-30 21:10:00", True),
        (6, "Sunflower seeds", "seeds", 5, 4.9, "2023-05-11 13:55:00", True),
    ]
    df = spark.createDataFrame(
        rows, "id long, title string, category string, price long, rating double, published string, in_stock boolean"
    )
    return df.selectExpr("*", "cast(published as timestamp_ntz) as published_date").drop("published")


@pytest.fixture(scope="session")
def guides(spark):
    rows = [
        (1, "Sourdough Bread Handbook", "Mix flour and water then bake bread slowly", 24, 71, 4.4, True, 1577934245),
        (2, "Pasta Notes", "Fresh bread crumbs and pasta by hand", 12, -3, 3.6, False, 1580601600),
        (3, "Bread Ovens", "How stone ovens hold heat for bread", 38, 64, 4.1, True, 1583107200),
        (4, "Garden Herbs", "Growing thyme and sage in small pots", 17, 50, 3.2, True, 1585699200),
    ]
    df = spark.createDataFrame(
        rows,
        "id long, title string, content string, price long, score long, rating double, active boolean, epoch long",
    )
    return df.selectExpr("*", "timestampadd(SECOND, epoch, timestamp_ntz'1970-01-01') as created_at").drop("epoch")
