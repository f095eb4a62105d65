"""SQL counterparts of the mapped tables, put together in dependency order."""

from __future__ import annotations


def I(e: str) -> str:
    return f"cast({e} as bigint)"


def D(e: str) -> str:
    return f"round_even(cast({e} as double) * 1e6, 0) / 1e6"


def MEAN(e: str) -> str:
    return f"cast(sum({e}) as double) / nullif(count({e}), 0)"


def hit(column: str, prime: int, rest: int) -> str:
    return f"({column} % {prime} = {rest})"


ORDER = "TransactionDate, TransactionID, LineNumber, ProductID, StoreID, Quantity, LineTotal"
DATES = ("1995-01-01", "2001-12-31")

TABLES: dict[str, tuple[list[str], str]] = {}


def table(name: str, needs: list[str], sql: str) -> None:
    TABLES[name] = (needs, sql)


table("lines", [], """
  SELECT l_orderkey AS TransactionID, l_suppkey AS StoreID, l_partkey AS ProductID,
         cast(l_quantity AS integer) AS Quantity,
         cast((2 * cast(round(l_extendedprice * 100) AS bigint) + cast(l_quantity AS bigint))
              // (2 * cast(l_quantity AS bigint)) * 0.01 AS decimal(18,2)) AS UnitPrice,
         cast(l_extendedprice AS decimal(18,2)) AS LineTotal,
         l_linenumber AS LineNumber, l_returnflag AS ReturnFlag
  FROM lineitem""")
table("tx", ["lines"], """
  SELECT lines.*, o_custkey AS CustomerID, cast(o_orderdate AS date) AS TransactionDate
  FROM lines JOIN orders ON o_orderkey = TransactionID""")
table("refd", ["tx"], "SELECT max(TransactionDate) AS ref FROM tx")
table("products", [], """
  SELECT p_partkey AS ProductID, p_name AS ProductName, p_type AS Category,
         cast(p_retailprice AS decimal(18,2)) AS Price,
         cast(round(cast(p_retailprice AS decimal(18,2)) * cast(0.6 AS decimal(2,1)), 2) AS decimal(18,2)) AS Cost
  FROM part""")
table("stores", [], """
  SELECT s_suppkey AS StoreID, s_name AS StoreName, n_name AS City, n_name AS Province
  FROM supplier JOIN nation ON s_nationkey = n_nationkey""")
table("customers", [], """
  SELECT c_custkey AS CustomerID, c_name AS FirstName, c_mktsegment AS LastName, n_name AS City, n_name AS Province,
         EnrollmentDate
  FROM customer JOIN nation ON c_nationkey = n_nationkey
  LEFT JOIN (SELECT o_custkey, cast(min(o_orderdate) AS date) AS EnrollmentDate FROM orders GROUP BY o_custkey) e
    ON o_custkey = c_custkey""")
table("ledger1", ["tx"], f"""
  SELECT *, cast(LineTotal * 0.01 AS decimal(18,4)) AS amount,
         CASE WHEN ReturnFlag = 'R' THEN 500 ELSE 0 END AS PointsRedeemed,
         sum(cast(LineTotal * 0.01 AS decimal(18,4))) OVER w AS CumulativeSpend,
         row_number() OVER w AS seq
  FROM tx WINDOW w AS (PARTITION BY CustomerID ORDER BY {ORDER} ROWS UNBOUNDED PRECEDING)""")
table("ledger2", ["ledger1"], """
  SELECT *, CASE Tier WHEN 'Platinum' THEN 1.50 WHEN 'Gold' THEN 1.25 WHEN 'Silver' THEN 1.15 ELSE 1.00 END::decimal(5,2)
              AS PointsPerDollar
  FROM (SELECT *, CASE WHEN CumulativeSpend >= 50000 THEN 'Platinum' WHEN CumulativeSpend >= 25000 THEN 'Gold'
                       WHEN CumulativeSpend >= 10000 THEN 'Silver' ELSE 'Bronze' END AS Tier FROM ledger1)""")
table("ledger3", ["ledger2"], """
  SELECT *, cast(round_even(amount * PointsPerDollar, 0) AS bigint) AS PointsEarned FROM ledger2""")
table("ledger4", ["ledger3"], """
  SELECT *, cast(sum(PointsEarned - PointsRedeemed) OVER (PARTITION BY CustomerID ORDER BY seq ROWS UNBOUNDED PRECEDING)
              AS bigint) AS net FROM ledger3""")
table("loyalty", ["ledger4"], """
  SELECT seq AS LoyaltyRecordID, CustomerID, TransactionID, TransactionDate, PointsEarned,
         cast(PointsRedeemed AS bigint) AS PointsRedeemed,
         net - least(0, min(net) OVER (PARTITION BY CustomerID ORDER BY seq ROWS UNBOUNDED PRECEDING)) AS PointsBalance,
         Tier, PointsPerDollar, CumulativeSpend
  FROM ledger4""")
table("latest", ["loyalty"], """
  SELECT l.* FROM loyalty l JOIN (SELECT CustomerID, max(TransactionDate) AS d FROM loyalty GROUP BY CustomerID) m
    ON l.CustomerID = m.CustomerID AND l.TransactionDate = m.d""")
table("surveys", [], """
  SELECT event_id AS SurveyID, user_id AS CustomerID, cast(ts AS date) AS SurveyDate,
         cast(event_id % 5 + 1 AS integer) AS SatisfactionScore, cast(event_id % 11 AS integer) AS NPSScore,
         event_type AS Feedback, CASE WHEN event_id % 11 >= 7 THEN 'Yes' ELSE 'No' END AS WouldRecommend
  FROM events""")
table("rfm", ["tx", "refd"], """
  SELECT CustomerID, datediff('day', max(TransactionDate), (SELECT ref FROM refd)) AS Recency,
         count(DISTINCT TransactionDate) AS Frequency, sum(LineTotal) AS Monetary
  FROM tx GROUP BY CustomerID""")

T = "TransactionID"
table("dirty_tx", ["tx"], f"""
  SELECT TransactionID, CustomerID, TransactionDate, StoreID, ProductID, Quantity, UnitPrice,
         cast(LineTotal + copy AS decimal(18,2)) AS LineTotal, LineNumber
  FROM (SELECT TransactionID,
          CASE WHEN NOT {hit(T, 97, 0)} THEN CustomerID END AS CustomerID,
          CASE WHEN {hit(T, 71, 6)} THEN DATE '2030-01-01' ELSE TransactionDate END AS TransactionDate,
          StoreID, ProductID,
          CASE WHEN {hit(T, 89, 1)} THEN -1 WHEN {hit(T, 83, 2)} THEN 5000 ELSE Quantity END AS Quantity,
          CASE WHEN {hit(T, 79, 3)} THEN 0 WHEN {hit(T, 101, 4)} THEN UnitPrice * 50 ELSE UnitPrice END::decimal(18,2) AS UnitPrice,
          CASE WHEN {hit(T, 73, 5)} THEN LineTotal + 5 ELSE LineTotal END::decimal(18,2) AS LineTotal,
          LineNumber, unnest(CASE WHEN {hit(T, 67, 7)} THEN [0, 1] ELSE [0] END) AS copy
        FROM tx)""")
table("cln1", ["dirty_tx"], """
  SELECT * FROM dirty_tx WHERE TransactionID IS NOT NULL AND CustomerID IS NOT NULL AND ProductID IS NOT NULL
    AND TransactionDate IS NOT NULL""")
table("cln2", ["cln1"], """
  SELECT * FROM cln1 QUALIFY row_number() OVER (PARTITION BY TransactionID, CustomerID, ProductID, TransactionDate
    ORDER BY LineNumber, StoreID, Quantity, UnitPrice, LineTotal) = 1""")
table("cln3", ["cln2"], """
  SELECT * REPLACE (cast(CASE WHEN Quantity <= 0 OR Quantity > 1000 THEN 1 ELSE Quantity END AS integer) AS Quantity)
  FROM cln2""")
table("cln4", ["cln3"], "SELECT * FROM cln3 WHERE NOT coalesce(UnitPrice <= 0, false)")
table("clnstat", ["cln4"], """
  SELECT avg(cast(UnitPrice AS double)) AS mu, stddev_samp(cast(UnitPrice AS double)) AS sd FROM cln4""")
table("cln5", ["cln4", "clnstat"], """
  SELECT * EXCLUDE (p, capped) REPLACE (p AS UnitPrice,
           CASE WHEN capped THEN cast(round(p * Quantity, 2) AS decimal(18,2)) ELSE LineTotal END AS LineTotal)
  FROM (SELECT cln4.*, UnitPrice > mu + 3 * sd OR UnitPrice < mu - 3 * sd AS capped,
          CASE WHEN UnitPrice > mu + 3 * sd THEN cast(mu + 3 * sd AS decimal(18,6))
               WHEN UnitPrice < mu - 3 * sd THEN cast(greatest(0, mu - 3 * sd) AS decimal(18,6))
               ELSE cast(UnitPrice AS decimal(18,6)) END AS p
        FROM cln4, clnstat)""")
table("cln6", ["cln5"], """
  SELECT * REPLACE (CASE WHEN abs(LineTotal - round(UnitPrice * Quantity, 2)) > 0.01
                         THEN cast(round(UnitPrice * Quantity, 2) AS decimal(18,2)) ELSE LineTotal END AS LineTotal)
  FROM cln5""")
table("cln7", ["cln6"], f"""
  SELECT * FROM cln6 WHERE TransactionDate BETWEEN DATE '{DATES[0]}' AND DATE '{DATES[1]}'""")
table("dirty_loyalty", ["loyalty"], f"""
  SELECT LoyaltyRecordID, CASE WHEN NOT {hit(T, 97, 0)} THEN CustomerID END AS CustomerID, TransactionID, TransactionDate,
         CASE WHEN {hit(T, 89, 1)} THEN -PointsEarned ELSE PointsEarned END AS PointsEarned,
         CASE WHEN {hit(T, 83, 2)} THEN -PointsRedeemed ELSE PointsRedeemed END AS PointsRedeemed,
         CASE WHEN {hit(T, 79, 3)} THEN -7 ELSE PointsBalance END AS PointsBalance,
         CASE WHEN {hit(T, 73, 5)} THEN 'Diamond' WHEN NOT {hit(T, 71, 6)} THEN Tier END AS Tier, PointsPerDollar
  FROM loyalty""")
table("clean_loyalty", ["dirty_loyalty"], """
  SELECT LoyaltyRecordID, CustomerID, TransactionID, TransactionDate,
         CASE WHEN PointsEarned < 0 THEN 0 ELSE PointsEarned END AS PointsEarned,
         CASE WHEN PointsRedeemed < 0 THEN 0 ELSE PointsRedeemed END AS PointsRedeemed,
         CASE WHEN PointsBalance < 0 THEN 0 ELSE PointsBalance END AS PointsBalance,
         CASE WHEN Tier IN ('Bronze', 'Silver', 'Gold', 'Platinum') THEN Tier ELSE 'Bronze' END AS Tier, PointsPerDollar
  FROM dirty_loyalty WHERE CustomerID IS NOT NULL AND TransactionID IS NOT NULL AND TransactionDate IS NOT NULL""")
S = "SurveyID"
table("dirty_surveys", ["surveys"], f"""
  SELECT SurveyID, CASE WHEN NOT {hit(S, 97, 0)} THEN CustomerID END AS CustomerID, SurveyDate,
         CASE WHEN {hit(S, 89, 1)} THEN 9 WHEN {hit(S, 83, 2)} THEN -2 WHEN NOT {hit(S, 79, 3)} THEN SatisfactionScore END
           AS SatisfactionScore,
         CASE WHEN {hit(S, 73, 5)} THEN 15 WHEN {hit(S, 71, 6)} THEN -1 WHEN NOT {hit(S, 67, 7)} THEN NPSScore END AS NPSScore,
         Feedback, WouldRecommend
  FROM surveys""")
table("clipped_surveys", ["dirty_surveys"], """
  SELECT * REPLACE (CASE WHEN SatisfactionScore < 1 THEN 1 WHEN SatisfactionScore > 5 THEN 5 ELSE SatisfactionScore END
                      AS SatisfactionScore,
                    CASE WHEN NPSScore < 0 THEN 0 WHEN NPSScore > 10 THEN 10 ELSE NPSScore END AS NPSScore)
  FROM dirty_surveys WHERE CustomerID IS NOT NULL""")

# Customer features -----------------------------------------------------------------------------

table("f_life", ["tx", "refd"], """
  SELECT CustomerID, datediff('day', max(TransactionDate), (SELECT ref FROM refd)) AS Recency, count(*) AS Frequency,
         sum(LineTotal) AS TotalSpend, cast(sum(LineTotal) AS double) / count(*) AS AvgTransactionValue,
         datediff('day', min(TransactionDate), max(TransactionDate)) AS CustomerLifetime,
         max(TransactionDate) AS LastPurchaseDate, min(TransactionDate) AS FirstPurchaseDate
  FROM tx GROUP BY CustomerID""")
table("f_rank", ["f_life"], """
  SELECT *, count(*) OVER () AS n, row_number() OVER (ORDER BY Recency, CustomerID) AS rr,
         row_number() OVER (ORDER BY Frequency, CustomerID) AS rf,
         row_number() OVER (ORDER BY TotalSpend, CustomerID) AS rm
  FROM f_life""")
table("f_rfm", ["f_rank"], """
  SELECT CustomerID, Recency, Frequency, TotalSpend, AvgTransactionValue, TotalSpend AS LifetimeValue, CustomerLifetime,
         cast(CustomerLifetime AS double) / Frequency AS AvgDaysBetweenPurchases,
         RecencyScore, FrequencyScore, MonetaryScore,
         RecencyScore * 100 + FrequencyScore * 10 + MonetaryScore AS RFMScore, LastPurchaseDate, FirstPurchaseDate
  FROM (SELECT *, 6 - greatest(1, (5 * (rr - 1) + n - 2) // greatest(n - 1, 1)) AS RecencyScore,
               greatest(1, (5 * (rf - 1) + n - 2) // greatest(n - 1, 1)) AS FrequencyScore,
               greatest(1, (5 * (rm - 1) + n - 2) // greatest(n - 1, 1)) AS MonetaryScore FROM f_rank)""")
_periods = ", ".join(
    f"count(*) FILTER (TransactionDate >= ref - {n}) AS Frequency_{n}d, "
    f"coalesce(sum(LineTotal) FILTER (TransactionDate >= ref - {n}), 0) AS Spend_{n}d" for n in (30, 60, 90, 365))
table("f_period", ["tx", "refd"], f"""
  SELECT CustomerID, {_periods} FROM tx, refd WHERE TransactionDate >= ref - 365 GROUP BY CustomerID""")
_trend = ", ".join(
    f"count(*) FILTER ({w}) AS {p}Frequency, coalesce(sum(LineTotal) FILTER ({w}), 0) AS {p}Spend, "
    f"coalesce(cast(sum(LineTotal) FILTER ({w}) AS double) / nullif(count(*) FILTER ({w}), 0), 0) AS {p}AvgTransaction, "
    f"coalesce(cast(sum(Quantity) FILTER ({w}) AS double) / nullif(count(*) FILTER ({w}), 0), 0) AS {p}AvgBasketSize"
    for p, w in (("Recent", "TransactionDate >= ref - 90"), ("Historical", "TransactionDate < ref - 90")))
table("f_trend1", ["tx", "refd"], f"""
  SELECT CustomerID, {_trend} FROM tx, refd WHERE TransactionDate >= ref - 180 GROUP BY CustomerID""")
table("f_trend2", ["f_trend1"], """
  SELECT *, cast(RecentFrequency - HistoricalFrequency AS double) / (HistoricalFrequency + 1) AS FrequencyTrend,
         (cast(RecentSpend AS double) - cast(HistoricalSpend AS double)) / (cast(HistoricalSpend AS double) + 1) AS SpendingTrend,
         (RecentAvgBasketSize - HistoricalAvgBasketSize) / (HistoricalAvgBasketSize + 1) AS BasketSizeTrend
  FROM f_trend1""")
table("f_trend", ["f_trend2"], """
  SELECT *, CASE WHEN FrequencyTrend > 0.1::double THEN 'increasing' WHEN FrequencyTrend < -0.1::double THEN 'decreasing'
                 ELSE 'stable' END AS FrequencyTrendDirection,
         CASE WHEN SpendingTrend > 0.1::double THEN 'increasing' WHEN SpendingTrend < -0.1::double THEN 'decreasing'
              ELSE 'stable' END AS SpendingTrendDirection
  FROM f_trend2""")
_q = [f"count(*) FILTER (quarter(TransactionDate) = {q})" for q in range(1, 5)]
table("f_season1", ["tx"], f"""
  SELECT CustomerID, count(*) AS TotalTransactions, sum(LineTotal) AS TotalSpend,
         count(*) FILTER (month(TransactionDate) IN (11, 12, 1, 2)) AS HolidayTransactions,
         {", ".join(f"{e} AS Q{i}_Transactions" for i, e in enumerate(_q, 1))}
  FROM tx GROUP BY CustomerID""")
table("f_season", ["f_season1", "tx"], """
  SELECT s.*, cast(HolidayTransactions AS double) / TotalTransactions AS HolidayActivityRatio, PreferredQuarter
  FROM f_season1 s JOIN (
    SELECT CustomerID, PreferredQuarter
    FROM (SELECT CustomerID, quarter(TransactionDate) AS PreferredQuarter, count(*) AS c FROM tx GROUP BY 1, 2)
    QUALIFY row_number() OVER (PARTITION BY CustomerID ORDER BY c DESC, PreferredQuarter) = 1
  ) p ON p.CustomerID = s.CustomerID""")
table("f_engage1", ["tx", "products"], """
  SELECT CustomerID, count(DISTINCT TransactionDate) AS DaysActive, count(DISTINCT tx.ProductID) AS UniqueProducts,
         count(DISTINCT Category) AS UniqueCategories, sum(Quantity) AS TotalItemsPurchased, count(*) AS TotalTransactions,
         greatest(1, cast(round(datediff('day', min(TransactionDate), max(TransactionDate)) / 30.44::double) AS bigint)) AS ActiveMonths
  FROM tx LEFT JOIN products ON products.ProductID = tx.ProductID GROUP BY CustomerID""")
table("f_engage", ["f_engage1", "tx"], """
  SELECT e.*, AvgBasketSize, cast(TotalTransactions AS double) / ActiveMonths AS PurchaseVelocity,
         cast(UniqueProducts AS double) / TotalTransactions AS ProductDiversity
  FROM f_engage1 e JOIN (
    SELECT CustomerID, cast(sum(b) AS double) / count(*) AS AvgBasketSize
    FROM (SELECT CustomerID, TransactionID, sum(Quantity) AS b FROM tx GROUP BY ALL) GROUP BY CustomerID
  ) b ON b.CustomerID = e.CustomerID""")
table("tier_lag", ["loyalty"], """
  SELECT *, lag(Tier) OVER (PARTITION BY CustomerID ORDER BY TransactionDate, LoyaltyRecordID) AS PreviousTier FROM loyalty""")
table("f_loyalty", ["tier_lag", "customers", "refd"], """
  SELECT a.*, coalesce(cast(TotalPointsRedeemed AS double) / nullif(TotalPointsEarned, 0), 0) AS RedemptionRate, EnrollmentDate,
         datediff('day', EnrollmentDate, (SELECT ref FROM refd)) AS DaysSinceEnrollment,
         CurrentPointsPerDollar AS PointsPerDollarRatio,
         CASE CurrentTier WHEN 'Platinum' THEN 4 WHEN 'Gold' THEN 3 WHEN 'Silver' THEN 2 ELSE 1 END AS TierNumeric
  FROM (SELECT CustomerID, sum(PointsEarned) AS TotalPointsEarned, cast(sum(PointsEarned) AS double) / count(*) AS AvgPointsEarned,
          count(*) AS PointsTransactions, sum(PointsRedeemed) AS TotalPointsRedeemed,
          cast(sum(PointsRedeemed) AS double) / count(*) AS AvgPointsRedeemed,
          arg_max(PointsBalance, LoyaltyRecordID) AS CurrentPointsBalance, arg_max(Tier, LoyaltyRecordID) AS CurrentTier,
          arg_max(PointsPerDollar, LoyaltyRecordID) AS CurrentPointsPerDollar,
          count(*) FILTER (PreviousTier IS NOT NULL AND PreviousTier <> Tier) AS TierChanges
        FROM tier_lag GROUP BY CustomerID) a
  LEFT JOIN (SELECT CustomerID AS c, EnrollmentDate FROM customers) ON c = a.CustomerID""")
table("f_survey", ["surveys"], """
  SELECT CustomerID, cast(sum(SatisfactionScore) AS double) / count(*) AS AvgSatisfactionScore,
         cast(sum(NPSScore) AS double) / count(*) AS AvgNPSScore,
         cast(count(*) FILTER (WouldRecommend = 'Yes') AS double) / count(*) AS RecommendationRate
  FROM surveys GROUP BY CustomerID""")

WHOLE, REAL, TEXT = "bigint", "double", "text"
FEATURES: dict[str, tuple[str, str]] = {}  # feature -> (source table, kind)
for _names, _source, _kind in (
    ("Recency Frequency CustomerLifetime RecencyScore FrequencyScore MonetaryScore RFMScore", "f_rfm", WHOLE),
    ("TotalSpend AvgTransactionValue LifetimeValue AvgDaysBetweenPurchases", "f_rfm", REAL),
    ("LastPurchaseDate FirstPurchaseDate", "f_rfm", TEXT),
    ("Frequency_30d Frequency_60d Frequency_90d Frequency_365d", "f_period", WHOLE),
    ("Spend_30d Spend_60d Spend_90d Spend_365d", "f_period", REAL),
    ("TotalPointsEarned PointsTransactions TotalPointsRedeemed CurrentPointsBalance DaysSinceEnrollment TierNumeric TierChanges",
     "f_loyalty", WHOLE),
    ("AvgPointsEarned AvgPointsRedeemed CurrentPointsPerDollar RedemptionRate PointsPerDollarRatio", "f_loyalty", REAL),
    ("CurrentTier EnrollmentDate", "f_loyalty", TEXT),
    ("DaysActive ActiveMonths UniqueProducts UniqueCategories TotalItemsPurchased TotalTransactions", "f_engage", WHOLE),
    ("AvgBasketSize PurchaseVelocity ProductDiversity", "f_engage", REAL),
    ("RecentFrequency HistoricalFrequency", "f_trend", WHOLE),
    ("RecentSpend RecentAvgTransaction RecentAvgBasketSize HistoricalSpend HistoricalAvgTransaction HistoricalAvgBasketSize "
     "FrequencyTrend SpendingTrend BasketSizeTrend", "f_trend", REAL),
    ("FrequencyTrendDirection SpendingTrendDirection", "f_trend", TEXT),
    ("HolidayTransactions Q1_Transactions Q2_Transactions Q3_Transactions Q4_Transactions PreferredQuarter", "f_season", WHOLE),
    ("HolidayActivityRatio", "f_season", REAL),
    ("AvgSatisfactionScore AvgNPSScore RecommendationRate", "f_survey", REAL),
):
    for _n in _names.split():
        FEATURES[_n] = (_source, _kind)


def typed(name: str, kind: str, source: str = "", fill: bool = False) -> str:
    e = f"{source}.{name}" if source else name
    if kind == WHOLE:
        return f"{I(f'coalesce({e}, 0)' if fill else e)} AS {name}"
    if kind == REAL:
        return f"{D(f'coalesce({e}, 0)' if fill else e)} AS {name}"
    return f"{e} AS {name}"


_sources = ["f_rfm", "f_period", "f_loyalty", "f_engage", "f_trend", "f_season", "f_survey"]
table("features", ["customers", *_sources], "SELECT c.CustomerID, " + ", ".join(
    typed(n, kind, src, fill=True) for n, (src, kind) in FEATURES.items())
    + ", f_rfm.LastPurchaseDate IS NOT NULL AS IsActive FROM customers c "
    + " ".join(f"LEFT JOIN {s} ON {s}.CustomerID = c.CustomerID" for s in _sources))

table("scored", [], """
  SELECT c_custkey AS CustomerID, cast(c_custkey * 37 % 101 AS double) / 100 AS ChurnProbability,
         CASE WHEN c_custkey * 37 % 101 + c_custkey % 7 * 9 >= 75 THEN 1 ELSE 0 END AS Churn
  FROM customer""")
table("predictions", ["scored"], """
  SELECT CustomerID, ChurnProbability, CASE WHEN ChurnProbability >= 0.5 THEN 1 ELSE 0 END AS ChurnPrediction,
         CASE WHEN ChurnProbability <= 0 THEN NULL WHEN ChurnProbability <= 0.3::double THEN 'Low'
              WHEN ChurnProbability <= 0.6::double THEN 'Medium' WHEN ChurnProbability <= 0.8::double THEN 'High'
              WHEN ChurnProbability <= 1 THEN 'Critical' END AS RiskLevel
  FROM scored""")
table("seg_labels", [], "SELECT c_custkey AS CustomerID, cast(c_custkey % 5 AS integer) AS Segment FROM customer")


def with_tables(body: str, *names: str) -> str:
    """``body`` behind the WITH clause of the named tables and everything they need."""
    order: list[str] = []

    def visit(name: str) -> None:
        if name in order:
            return
        for needed in TABLES[name][0]:
            visit(needed)
        order.append(name)

    for n in names:
        visit(n)
    clauses = ",\n".join(f"{n} AS ({TABLES[n][1]})" for n in order)
    return f"WITH {clauses}\n{body}" if order else body
