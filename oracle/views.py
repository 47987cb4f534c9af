"""Common table expressions that rebuild the warehouse layers in SQL."""

from __future__ import annotations

import re

VIEWS: dict[str, str] = {}

VIEWS["staging_retail"] = """
SELECT CASE WHEN o_orderstatus = 'P' THEN concat('C', CAST(o_orderkey AS VARCHAR))
            ELSE CAST(o_orderkey AS VARCHAR) END AS Invoice,
       CAST(l_partkey AS VARCHAR) AS StockCode, concat(' ', p_name, ' ') AS Description,
       CAST(CASE WHEN line % 97 = 0 THEN -l_quantity WHEN line % 101 = 0 THEN l_quantity * 40 ELSE l_quantity END AS INTEGER) AS Quantity,
       o_orderdate AS InvoiceDate,
       CAST(CASE WHEN line % 89 = 0 THEN 0 ELSE l_extendedprice END AS DECIMAL(10,2)) AS Price,
       CASE WHEN o_custkey % 50 <> 0 THEN o_custkey END AS CustomerID, n_name AS Country
FROM (SELECT *, l_orderkey * 10 + l_linenumber AS line FROM lineitem) JOIN orders ON l_orderkey = o_orderkey
     JOIN part ON l_partkey = p_partkey JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey
     JOIN (VALUES (1), (2)) AS copies(copy) ON copy = 1 OR line % 50 = 7
"""

VIEWS["deduped"] = """
SELECT upper(trim(Invoice)) AS Invoice, upper(trim(StockCode)) AS StockCode, CustomerID, Quantity, Price,
       max(upper(Description)) AS Description, max(InvoiceDate) AS InvoiceDate, max(Country) AS Country
FROM staging_retail
WHERE CustomerID IS NOT NULL AND upper(Invoice) NOT LIKE 'C%' AND Quantity > 0 AND Price > 0
GROUP BY 1, 2, 3, 4, 5
"""

VIEWS["clean_retail"] = """
SELECT Invoice, StockCode, CustomerID, Quantity, Price, InvoiceDate, Country,
       coalesce(trim(Description), 'UNKNOWN') AS Description,
       CAST(Quantity * Price AS DECIMAL(12,2)) AS TotalPrice, CAST(InvoiceDate AS DATE) AS InvoiceDay,
       year(InvoiceDate) AS Year, month(InvoiceDate) AS Month, dayname(InvoiceDate) AS DayOfWeek,
       hour(InvoiceDate) AS Hour, CASE WHEN dayofweek(InvoiceDate) IN (0, 6) THEN 1 ELSE 0 END AS IsWeekend,
       quarter(InvoiceDate) AS Quarter,
       CASE WHEN regexp_matches(Description, 'BOLT|ROD|GEAR') THEN 'Hardware'
            WHEN regexp_matches(Description, 'PLATE|ANVIL') THEN 'Metalwork'
            WHEN regexp_matches(Description, 'RING') THEN 'Jewellery'
            ELSE 'General' END AS ProductCategory
FROM deduped
"""

VIEWS["dim_time"] = """
SELECT row_number() OVER (ORDER BY FullDate) AS TimeID, FullDate, day(FullDate) AS Day,
       dayname(FullDate) AS DayOfWeek, month(FullDate) AS Month, monthname(FullDate) AS MonthName,
       quarter(FullDate) AS Quarter, year(FullDate) AS Year,
       CASE WHEN dayofweek(FullDate) IN (0, 6) THEN 1 ELSE 0 END AS IsWeekend, 0 AS IsHoliday
FROM (SELECT DISTINCT InvoiceDay AS FullDate FROM clean_retail)
"""

VIEWS["dim_location"] = """
SELECT row_number() OVER (ORDER BY c.Country) AS LocationID, c.Country,
       coalesce(r_name, 'Other') AS Region, 'N/A' AS City
FROM (SELECT DISTINCT Country FROM clean_retail) c
     LEFT JOIN nation ON c.Country = n_name LEFT JOIN region ON n_regionkey = r_regionkey
"""

VIEWS["dim_product"] = """
SELECT row_number() OVER (ORDER BY substr(md5(StockCode), 1, 3), StockCode) AS ProductID, StockCode, ProductName,
       Category, 'N/A' AS SubCategory, avg_price AS AvgPrice, 0.0::DOUBLE AS AvgRating,
       CAST(NULL AS VARCHAR) AS ImageCategory,
       CASE WHEN avg_price <= 48000 THEN 'Low' WHEN avg_price <= 53000 THEN 'Medium'
            WHEN avg_price <= 58000 THEN 'High' ELSE 'Premium' END AS PriceRange
FROM (SELECT StockCode, max(Description) AS ProductName, max(ProductCategory) AS Category,
             CAST(sum(Price) AS DOUBLE) / count(Price) AS avg_price
      FROM clean_retail GROUP BY StockCode)
"""

VIEWS["rfm_base"] = """
SELECT CustomerID, max(InvoiceDay) AS last_day, max(InvoiceDate) AS last_ts,
       datediff('day', max(InvoiceDay), (SELECT max(InvoiceDay) + 1 FROM clean_retail)) AS Recency,
       count(DISTINCT Invoice) AS Frequency, sum(TotalPrice) AS Monetary, min(InvoiceDay) AS JoinDate
FROM clean_retail GROUP BY CustomerID
"""

VIEWS["rfm_table"] = """
SELECT CustomerID, Recency, Frequency, Monetary, JoinDate,
       CAST(Monetary AS DOUBLE) / Frequency AS AvgOrderValue,
       CASE WHEN Recency > 180 THEN 1 WHEN Recency > 90 AND Frequency <= 2 THEN 1
            WHEN Recency > 60 AND Frequency = 1 AND Monetary < 100 THEN 1 ELSE 0 END AS ChurnLabel
FROM rfm_base
"""

VIEWS["modal_country"] = """
SELECT CustomerID, Country FROM (
  SELECT CustomerID, Country, row_number() OVER (PARTITION BY CustomerID ORDER BY count(*) DESC, Country) AS rn
  FROM clean_retail GROUP BY CustomerID, Country) WHERE rn = 1
"""

VIEWS["favourite_product"] = """
SELECT CustomerID, Description AS FavoriteProduct FROM (
  SELECT CustomerID, Description,
         row_number() OVER (PARTITION BY CustomerID ORDER BY count(*) DESC, Description) AS rn
  FROM clean_retail GROUP BY CustomerID, Description) WHERE rn = 1
"""

VIEWS["dim_customer"] = """
SELECT r.CustomerID, c.Country, 'Unknown' AS AgeGroup, JoinDate, Recency, Frequency, Monetary, AvgOrderValue,
       CAST(NULL AS VARCHAR) AS RFM_Segment, ChurnLabel
FROM rfm_table r LEFT JOIN modal_country c USING (CustomerID)
"""

VIEWS["fact_orders"] = """
SELECT md5(concat_ws('|', c.Invoice, c.StockCode, CAST(c.CustomerID AS VARCHAR), CAST(c.Quantity AS VARCHAR),
                     CAST(c.Price AS VARCHAR))) AS OrderID,
       Invoice AS InvoiceNo, CustomerID, ProductID, TimeID, LocationID, Quantity, Price AS UnitPrice, TotalPrice,
       0 AS Discount
FROM clean_retail c JOIN dim_product p ON c.StockCode = p.StockCode
     JOIN dim_time t ON c.InvoiceDay = t.FullDate JOIN dim_location l ON c.Country = l.Country
"""

VIEWS["star"] = """
SELECT f.*, p.StockCode, p.ProductName, p.Category, p.PriceRange, t.FullDate, t.Year, t.Month, t.MonthName,
       t.Quarter, t.DayOfWeek, t.IsWeekend, l.Country, l.Region
FROM fact_orders f JOIN dim_product p ON f.ProductID = p.ProductID JOIN dim_time t ON f.TimeID = t.TimeID
     JOIN dim_location l ON f.LocationID = l.LocationID
"""

VIEWS["final_customer_dataset"] = """
SELECT c.CustomerID, c.Country, c.JoinDate, c.Recency, c.Frequency, c.Monetary, c.AvgOrderValue, c.ChurnLabel,
       coalesce(o.TotalItems, 0) AS TotalItems, coalesce(o.UniqueProducts, 0) AS UniqueProducts,
       coalesce(o.TotalOrders, 0) AS TotalOrders, coalesce(o.FirstOrderDate, c.JoinDate) AS FirstOrderDate,
       coalesce(o.LastOrderDate, c.JoinDate) AS LastOrderDate,
       coalesce(datediff('day', o.FirstOrderDate, o.LastOrderDate), 0) AS CustomerLifespanDays, l.Region,
       coalesce(o.AvgQuantityPerOrder, 0) AS AvgQuantityPerOrder, coalesce(o.AvgPricePerItem, 0) AS AvgPricePerItem
FROM dim_customer c LEFT JOIN (
  SELECT CustomerID, sum(Quantity) AS TotalItems, count(DISTINCT ProductID) AS UniqueProducts,
         count(DISTINCT InvoiceNo) AS TotalOrders, min(FullDate) AS FirstOrderDate, max(FullDate) AS LastOrderDate,
         CAST(sum(Quantity) AS DOUBLE) / count(DISTINCT InvoiceNo) AS AvgQuantityPerOrder,
         CAST(sum(Quantity * UnitPrice) AS DOUBLE) / CAST(sum(Quantity) AS DOUBLE) AS AvgPricePerItem
  FROM star GROUP BY CustomerID) o ON c.CustomerID = o.CustomerID
  LEFT JOIN dim_location l ON c.Country = l.Country
"""

VIEWS["behaviour_features"] = """
SELECT CustomerID, count(DISTINCT Category) AS CategoryDiversity,
       count(DISTINCT CASE WHEN IsWeekend = 1 THEN OrderID END)::DOUBLE / nullif(count(OrderID), 0) AS WeekendRatio,
       CAST(sum(CASE WHEN PriceRange = 'Premium' THEN 1 ELSE 0 END) AS DOUBLE)
         / nullif(count(OrderID), 0) AS PremiumRatio,
       max(Month) AS LastPurchaseMonth, stddev_pop(CAST(TotalPrice AS DOUBLE)) AS SpendingStdDev
FROM star GROUP BY CustomerID
"""

VIEWS["staging_reviews"] = """
SELECT d.doc_id AS ReviewID, d.doc_id % 100 AS ClothingID, CAST(15 + d.doc_id % 60 AS INTEGER) AS Age,
       CASE WHEN d.doc_id % 7 = 0 THEN NULL WHEN d.doc_id % 11 = 0 THEN ' ' ELSE d.source END AS Title,
       CASE WHEN d.doc_id % 37 <> 0 THEN d.text END AS ReviewText,
       CAST(1 + d.doc_id % 5 AS INTEGER) AS Rating, CAST(coalesce(l.quality, 0) AS INTEGER) AS Recommended,
       CAST(d.n_chars % 20 AS INTEGER) AS PositiveFeedback, d.lang AS DivisionName,
       CASE WHEN d.doc_id % 13 <> 0 THEN d.source END AS DepartmentName,
       (['Dresses', 'Knits', 'Fine gauge', 'Blouses', 'Sweaters', 'Pants', 'Jeans', 'Skirts', 'Jackets',
         'Outerwear', 'Shorts', 'Lounge'])[CAST(d.doc_id % 12 AS INTEGER) + 1] AS ClassName
FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id
"""

VIEWS["clean_reviews"] = """
SELECT ReviewID, ClothingID, Age, CASE WHEN Title IS NULL OR trim(Title) = '' THEN 'Unknown' ELSE Title END AS Title,
       lower(trim(ReviewText)) AS ReviewText, Rating, Recommended, PositiveFeedback,
       coalesce(DivisionName, 'Unknown') AS DivisionName, coalesce(DepartmentName, 'Unknown') AS DepartmentName,
       coalesce(ClassName, 'Unknown') AS ClassName,
       CAST(length(lower(trim(ReviewText))) - length(replace(lower(trim(ReviewText)), ' ', '')) + 1 AS INTEGER)
         AS ReviewLength,
       CASE WHEN ClassName = 'Dresses' THEN 'Gaun' WHEN ClassName IN ('Knits', 'Fine gauge') THEN 'Kaos'
            WHEN ClassName = 'Blouses' THEN 'Kemeja' WHEN ClassName = 'Sweaters' THEN 'Sweter'
            WHEN ClassName = 'Pants' THEN 'Celana_Panjang' WHEN ClassName = 'Jeans' THEN 'Jeans'
            WHEN ClassName = 'Skirts' THEN 'Rok' WHEN ClassName = 'Jackets' THEN 'Jaket'
            WHEN ClassName = 'Outerwear' THEN 'Mantel' WHEN ClassName = 'Shorts' THEN 'Celana_Pendek'
            ELSE 'Lainnya' END AS CNN_Matched_Class
FROM staging_reviews WHERE ReviewText IS NOT NULL AND trim(ReviewText) <> ''
"""

VIEWS["basket_items"] = """
SELECT DISTINCT InvoiceNo, ProductName AS Item
FROM (SELECT InvoiceNo, ProductName, Quantity FROM star
      WHERE InvoiceNo IN (SELECT InvoiceNo FROM fact_orders GROUP BY InvoiceNo HAVING count(DISTINCT ProductID) >= 2)
        AND Quantity > 0)
WHERE ProductName IN (
  SELECT ProductName FROM star
  WHERE InvoiceNo IN (SELECT InvoiceNo FROM fact_orders GROUP BY InvoiceNo HAVING count(DISTINCT ProductID) >= 2)
  GROUP BY ProductName ORDER BY count(*) DESC, ProductName LIMIT 100)
"""

VIEWS["itemsets"] = """
SELECT Item AS Items, freq, freq::DOUBLE / n AS Support, 1 AS Length, Item AS a, NULL AS b
FROM (SELECT Item, count(*) AS freq FROM basket_items GROUP BY Item),
     (SELECT count(DISTINCT InvoiceNo) AS n FROM basket_items) WHERE freq::DOUBLE / n >= 0.004
UNION ALL
SELECT concat(a, ', ', b), freq, freq::DOUBLE / n, 2, a, b
FROM (SELECT x.Item AS a, y.Item AS b, count(*) AS freq
      FROM basket_items x JOIN basket_items y ON x.InvoiceNo = y.InvoiceNo AND x.Item < y.Item GROUP BY 1, 2),
     (SELECT count(DISTINCT InvoiceNo) AS n FROM basket_items) WHERE freq::DOUBLE / n >= 0.004
UNION ALL
SELECT concat(a, ', ', b, ', ', c), freq, freq::DOUBLE / n, 3, NULL, NULL
FROM (SELECT x.Item AS a, y.Item AS b, z.Item AS c, count(*) AS freq
      FROM basket_items x JOIN basket_items y ON x.InvoiceNo = y.InvoiceNo AND x.Item < y.Item
           JOIN basket_items z ON x.InvoiceNo = z.InvoiceNo AND y.Item < z.Item GROUP BY 1, 2, 3),
     (SELECT count(DISTINCT InvoiceNo) AS n FROM basket_items) WHERE freq::DOUBLE / n >= 0.004
"""

VIEWS["category_baskets"] = """
SELECT InvoiceNo, list_sort(list(DISTINCT Category)) AS items FROM star
WHERE InvoiceNo IN (SELECT InvoiceNo FROM fact_orders GROUP BY InvoiceNo HAVING count(DISTINCT ProductID) >= 2) AND Quantity > 0
GROUP BY InvoiceNo
"""

VIEWS["category_sets"] = """
SELECT s AS items, count(*) AS freq, n, count(*)::DOUBLE / n AS Support, CAST(len(s) AS BIGINT) AS Length
FROM (SELECT list_filter(list_transform(range(1, len(a) + 1), lambda i: CASE WHEN (mask >> (i - 1)) & 1 = 1 THEN a[i] END),
                         lambda x: x IS NOT NULL) AS s
      FROM (SELECT list_sort(list(DISTINCT Category)) AS a FROM dim_product), range(1, 64) AS masks(mask) WHERE mask < (1 << len(a)))
     JOIN category_baskets ON list_has_all(category_baskets.items, s), (SELECT count(*) AS n FROM category_baskets)
GROUP BY s, n HAVING count(*)::DOUBLE / n >= 0.05
"""

VIEWS["basket_rules"] = """
SELECT x AS Antecedent, y AS Consequent, p.Support, p.freq::DOUBLE / sx.freq AS Confidence,
       (p.freq::DOUBLE / sx.freq) / (sy.freq::DOUBLE / n) AS Lift
FROM (SELECT a AS x, b AS y, Support, freq FROM itemsets WHERE Length = 2
      UNION ALL SELECT b, a, Support, freq FROM itemsets WHERE Length = 2) p
     JOIN itemsets sx ON sx.Items = p.x AND sx.Length = 1 JOIN itemsets sy ON sy.Items = p.y AND sy.Length = 1,
     (SELECT count(DISTINCT InvoiceNo) AS n FROM basket_items)
WHERE p.freq::DOUBLE / sx.freq >= 0.05
"""

VIEWS["lexicon"] = """
SELECT * FROM (VALUES ('the', 0.4, 0.1, 0.2), ('of', -0.6, -0.2, 0.3), ('de', 1.1, 0.3, 0.5), ('and', 0.2, 0.05, 0.1),
  ('to', -0.3, -0.1, 0.2), ('in', 0.7, 0.25, 0.4), ('la', -1.3, -0.4, 0.6), ('der', 0.9, 0.3, 0.5),
  ('is', 1.5, 0.5, 0.7), ('that', -0.8, -0.3, 0.4), ('en', -0.5, -0.15, 0.3), ('for', 0.6, 0.2, 0.3),
  ('it', -1.1, -0.35, 0.5), ('on', 0.3, 0.1, 0.2), ('was', -1.7, -0.6, 0.8), ('die', -0.9, -0.3, 0.5),
  ('with', 1.2, 0.4, 0.6), ('que', 0.8, 0.3, 0.4), ('le', 0.5, 0.15, 0.3), ('be', 1.0, 0.35, 0.5))
  AS t(Word, Valence, Polarity, Subjectivity)
"""

VIEWS["review_tokens"] = """
SELECT ReviewID, w AS Word, lag(w) OVER (PARTITION BY ReviewID ORDER BY pos) AS prev
FROM (SELECT ReviewID, unnest(words) AS w, unnest(generate_series(1, len(words))) AS pos
      FROM (SELECT ReviewID, list_filter(list_transform(
              string_split(lower(trim(regexp_replace(regexp_replace(regexp_replace(regexp_replace(
                ReviewText, '<[^>]+>', '', 'g'), 'http\\S+|www\\S+', '', 'g'), '[^\\p{L}\\p{N}_\\s\\p{Z}.,!?''-]', '', 'g'),
                '[\\s\\p{Z}]+', ' ', 'g'))), ' '),
              lambda t: trim(t, '.,!?''-')), lambda t: t <> '') AS words
            FROM clean_reviews))
"""

VIEWS["lexicon_scores"] = """
SELECT r.ReviewID, coalesce(v, 0) / sqrt(coalesce(v, 0) * coalesce(v, 0) + 15) AS VADER_Score,
       coalesce(p, 0) AS TextBlob_Score, coalesce(s, 0) AS TextBlob_Subjectivity
FROM clean_reviews r LEFT JOIN (
  SELECT ReviewID, sum(CAST(Valence AS DOUBLE) * sgn) AS v, avg(CAST(Polarity AS DOUBLE) * sgn) AS p,
         avg(CAST(Subjectivity AS DOUBLE)) AS s
  FROM (SELECT t.ReviewID, l.*, CASE WHEN prev IN ('a', 'un', 'not', 'no') THEN -0.74::DOUBLE ELSE 1.0::DOUBLE END AS sgn
        FROM review_tokens t JOIN lexicon l ON t.Word = l.Word) GROUP BY ReviewID) h ON r.ReviewID = h.ReviewID
"""

VIEWS["ensemble_scores"] = """
SELECT s.*, tanh(((VADER_Score - vm) / vs + (TextBlob_Score - tm) / ts) / 2) AS Ensemble_Score,
       CASE WHEN VADER_Score >= 0.05 THEN 'Positive' WHEN VADER_Score <= -0.05 THEN 'Negative' ELSE 'Neutral' END
         AS VADER_Label,
       CASE WHEN TextBlob_Score >= 0.05 THEN 'Positive' WHEN TextBlob_Score <= -0.05 THEN 'Negative' ELSE 'Neutral' END
         AS TextBlob_Label
FROM lexicon_scores s, (SELECT avg(VADER_Score) AS vm, stddev_samp(VADER_Score) AS vs, avg(TextBlob_Score) AS tm,
                               stddev_samp(TextBlob_Score) AS ts FROM lexicon_scores)
"""

VIEWS["scored_reviews"] = """
SELECT c.*, e.VADER_Score, e.TextBlob_Score, e.TextBlob_Subjectivity, e.Ensemble_Score, e.VADER_Label, e.TextBlob_Label,
       CASE WHEN Ensemble_Score > 0.05 THEN 'Positive' WHEN Ensemble_Score < -0.05 THEN 'Negative' ELSE 'Neutral' END
         AS Final_Sentiment
FROM clean_reviews c JOIN ensemble_scores e ON c.ReviewID = e.ReviewID
"""

VIEWS["purchases"] = """
SELECT CustomerID, StockCode, ProductName, sum(Quantity) AS TotalQty FROM star WHERE Quantity > 0 GROUP BY 1, 2, 3
"""

VIEWS["best_items"] = """
SELECT StockCode, max(ProductName) AS ProductName FROM purchases GROUP BY StockCode
ORDER BY sum(TotalQty) DESC, StockCode LIMIT 200
"""

VIEWS["triples"] = """
SELECT CustomerID, StockCode, TotalQty, ln(1 + TotalQty::DOUBLE) AS Weight
FROM purchases WHERE StockCode IN (SELECT StockCode FROM best_items)
"""

VIEWS["norms"] = "SELECT CustomerID, sqrt(sum(Weight * Weight)) AS n FROM triples GROUP BY CustomerID"

VIEWS["similarities"] = """
SELECT u, v, round(d / (a.n * b.n), 9) AS sim
FROM (SELECT x.CustomerID AS u, y.CustomerID AS v, sum(x.Weight * y.Weight) AS d
      FROM triples x JOIN triples y ON x.StockCode = y.StockCode AND x.CustomerID <> y.CustomerID GROUP BY 1, 2)
     JOIN norms a ON u = a.CustomerID JOIN norms b ON v = b.CustomerID
"""

VIEWS["nearest"] = """
SELECT * FROM (SELECT u, v, sim, row_number() OVER (PARTITION BY u ORDER BY sim DESC, v) AS rn FROM similarities)
WHERE rn <= 10
"""

VIEWS["offers"] = """
SELECT *, row_number() OVER (PARTITION BY CustomerID ORDER BY score DESC, StockCode) AS rn
FROM (SELECT k.u AS CustomerID, t.StockCode, round(sum(k.sim * t.Weight), 9) AS score
      FROM nearest k JOIN triples t ON k.v = t.CustomerID
      WHERE NOT EXISTS (SELECT 1 FROM triples o WHERE o.CustomerID = k.u AND o.StockCode = t.StockCode)
      GROUP BY 1, 2)
WHERE score > 0
"""

VIEWS["class_items"] = """
SELECT *, row_number() OVER (PARTITION BY CNN_Matched_Class ORDER BY Item_Score DESC, ClassName) AS rn
FROM (SELECT CNN_Matched_Class, ClassName, avg(Rating) AS Avg_Rating, count(*) AS Review_Count,
             round(coalesce(avg(Ensemble_Score), 0) * 0.4 + avg(Rating) / 5.0 * 0.3
                   + coalesce(avg(Recommended), 0) * 0.3, 9) AS Item_Score
      FROM scored_reviews GROUP BY 1, 2)
"""

VIEWS["requests"] = """
SELECT CustomerID, (['Celana_Panjang', 'Celana_Pendek', 'Gaun', 'Jaket', 'Jeans', 'Kaos', 'Kemeja', 'Lainnya', 'Mantel',
                     'Rok', 'Sweter'])[CAST(CustomerID % 11 AS INTEGER) + 1] AS CNN_Matched_Class
FROM dim_customer
"""

VIEWS["rfm_z"] = """
SELECT CustomerID, (Recency - rm) / rs AS r, (Frequency - fm) / fs AS f, (CAST(Monetary AS DOUBLE) - mm) / ms AS m,
       Recency, Frequency, Monetary
FROM rfm_table, (SELECT avg(Recency) AS rm, stddev_pop(Recency) AS rs, avg(Frequency) AS fm, stddev_pop(Frequency) AS fs,
                        avg(CAST(Monetary AS DOUBLE)) AS mm, stddev_pop(CAST(Monetary AS DOUBLE)) AS ms FROM rfm_table)
"""

VIEWS["assigned"] = """
SELECT CustomerID, arg_min(i, (d, i)) AS Cluster, any_value(r) AS r, any_value(f) AS f, any_value(m) AS m,
       any_value(Recency) AS Recency, any_value(Frequency) AS Frequency, any_value(CAST(Monetary AS DOUBLE)) AS Monetary
FROM (SELECT z.*, i, round((r - cr) * (r - cr) + (f - cf) * (f - cf) + (m - cm) * (m - cm), 9) AS d
      FROM rfm_z z, (VALUES (0, -0.5::DOUBLE, 1.4::DOUBLE, 1.5::DOUBLE), (1, -0.45, 0.4, 0.3), (2, -0.4, -0.7, -0.7),
                            (3, 2.6, -1.2, -1.1), (4, 0.6, -0.3, -0.2)) AS c(i, cr, cf, cm))
GROUP BY CustomerID
"""

# One row per run of k-means: its centres as a list; a round assigns every customer and takes means.
VIEWS["kmeans_runs"] = """
WITH RECURSIVE starts AS (
    SELECT start, row_number() OVER (PARTITION BY start ORDER BY md5(concat(start, ':', CustomerID)), CAST(CustomerID AS VARCHAR)) AS i, {'r': r, 'f': f, 'm': m} AS x
    FROM rfm_z, (SELECT unnest(range(42, 52)) AS start)),
  rounds AS (
    SELECT 0 AS turn, k, start, list(x ORDER BY i) AS c, true AS moving FROM starts JOIN (SELECT unnest(range(2, 11)) AS k) ON i <= k GROUP BY k, start
    UNION ALL
    SELECT turn + 1, k, start, n, turn < 299 AND list_sum(list_transform(range(1, len(c) + 1), lambda i: (n[i].r - c[i].r) ** 2 + (n[i].f - c[i].f) ** 2 + (n[i].m - c[i].m) ** 2)) > 1e-4
    FROM (SELECT turn, k, start, c, list_transform(range(1, len(c) + 1), lambda i: coalesce(list_filter(g, lambda y: y.i = i)[1].x, c[i])) AS n
          FROM (SELECT turn, k, start, c, list({'i': near, 'x': {'r': r, 'f': f, 'm': m}}) AS g
                FROM (SELECT turn, k, start, c, near, avg(r) AS r, avg(f) AS f, avg(m) AS m
                      FROM (SELECT turn, k, start, c, z.r, z.f, z.m, list_position(d, list_min(d)) AS near
                            FROM (SELECT rounds.*, rfm_z.r, rfm_z.f, rfm_z.m,
                                         list_transform(c, lambda y: round((y.r - rfm_z.r) * (y.r - rfm_z.r) + (y.f - rfm_z.f) * (y.f - rfm_z.f) + (y.m - rfm_z.m) * (y.m - rfm_z.m), 9)) AS d
                                  FROM rounds, rfm_z WHERE moving) z)
                      GROUP BY turn, k, start, c, near)
                GROUP BY turn, k, start, c)))
SELECT k, start, c, sum(list_min(list_transform(c, lambda y: (y.r - z.r) * (y.r - z.r) + (y.f - z.f) * (y.f - z.f) + (y.m - z.m) * (y.m - z.m)))) AS cost
FROM rounds, rfm_z z WHERE NOT moving GROUP BY k, start, c
"""

VIEWS["kmeans_best"] = """
SELECT k, c, cost FROM (SELECT *, row_number() OVER (PARTITION BY k ORDER BY round(cost, 6), start) AS n FROM kmeans_runs) WHERE n = 1
"""

VIEWS["segment_centres"] = """
SELECT Cluster, avg(Recency) AS Recency, avg(Frequency) AS Frequency, avg(Monetary) AS Monetary
FROM assigned GROUP BY Cluster
"""

VIEWS["segment_names"] = """
SELECT Cluster, Recency, Frequency, Monetary,
       concat(label, CASE WHEN n = 1 THEN '' ELSE concat(' ', CAST(n AS VARCHAR)) END) AS RFM_Segment
FROM (SELECT *, row_number() OVER (PARTITION BY label ORDER BY Cluster) AS n
      FROM (SELECT c.*, CASE WHEN Recency < r AND Frequency > f AND Monetary > m THEN 'Champions'
                             WHEN Recency < r AND Frequency > f THEN 'Loyal' WHEN Recency < r THEN 'New Customers'
                             WHEN Recency > r75 THEN 'Lost' ELSE 'At Risk' END AS label
            FROM segment_centres c, (SELECT median(Recency) AS r, median(Frequency) AS f, median(Monetary) AS m,
                                            quantile_cont(Recency, 0.75) AS r75 FROM segment_centres)))
"""

VIEWS["segmented"] = """
SELECT d.* EXCLUDE (RFM_Segment), n.RFM_Segment FROM dim_customer d JOIN assigned a ON d.CustomerID = a.CustomerID
       JOIN segment_names n ON a.Cluster = n.Cluster
"""

VIEWS["churn_wide"] = """
SELECT c.*, b.* EXCLUDE (CustomerID), CAST(c.Monetary AS DOUBLE) AS mo, c.Frequency::DOUBLE AS fr,
       c.UniqueProducts::DOUBLE AS un, c.CustomerLifespanDays::DOUBLE AS li
FROM final_customer_dataset c JOIN behaviour_features b ON c.CustomerID = b.CustomerID
"""

VIEWS["churn_limits"] = """
SELECT round(median(mo), 6) AS m50, round(quantile_cont(mo, 0.25), 6) AS m25, round(median(fr), 6) AS f50,
       round(quantile_cont(mo, 0.01), 6) AS m1, round(quantile_cont(mo, 0.99), 6) AS m99,
       round(quantile_cont(fr, 0.01), 6) AS f1, round(quantile_cont(fr, 0.99), 6) AS f99,
       round(quantile_cont(un, 0.01), 6) AS u1, round(quantile_cont(un, 0.99), 6) AS u99,
       round(quantile_cont(AvgPricePerItem, 0.01), 6) AS p1, round(quantile_cont(AvgPricePerItem, 0.99), 6) AS p99
FROM churn_wide
"""

VIEWS["splits"] = """
SELECT CustomerID, ChurnLabel, Frequency, CASE WHEN x < 0.68::DOUBLE THEN 'train' WHEN x < 0.68::DOUBLE + 0.12::DOUBLE THEN 'validation'
       ELSE 'test' END AS split
FROM (SELECT *, CAST(concat('0x', substr(md5(concat_ws('|', '42', CAST(CustomerID AS VARCHAR))), 1, 8)) AS BIGINT)
                / 4294967296.0::DOUBLE AS x FROM rfm_table)
"""

VIEWS["curve_scores"] = """
SELECT CustomerID, ChurnLabel AS label, split, Model, weight, round(1 / (1 + exp(-(a + Frequency * b))), 3) AS score
FROM splits, (VALUES ('Gradient Boosting', 1.5::DOUBLE, -0.25::DOUBLE, 2.0::DOUBLE), ('Random Forest', 0.8, -0.1, 1.0),
                     ('SVM', 2.2, -0.4, 1.5)) AS c(Model, a, b, weight)
"""

VIEWS["thresholds"] = "SELECT i / 200.0::DOUBLE AS Threshold FROM range(60, 140) t(i)"

VIEWS["vote"] = """
SELECT CustomerID, label, sum(score * weight) / sum(weight) AS score FROM curve_scores GROUP BY 1, 2
"""

VIEWS["tuned"] = """
SELECT Model, Threshold, Accuracy FROM (
  SELECT *, row_number() OVER (PARTITION BY Model ORDER BY Accuracy DESC, Threshold) AS rn
  FROM (SELECT Model, Threshold, sum(((score >= Threshold)::INT = label)::INT)::DOUBLE / count(*) AS Accuracy
        FROM curve_scores, thresholds WHERE split = 'validation' GROUP BY 1, 2)) WHERE rn = 1
"""

VIEWS["test_metrics"] = """
SELECT Model, Threshold, tp, pred, pos, n, auc FROM (
  SELECT s.Model, t.Threshold, sum((score >= t.Threshold)::INT * label) AS tp, sum((score >= t.Threshold)::INT) AS pred,
         sum(label) AS pos, count(*) AS n
  FROM curve_scores s JOIN tuned t ON s.Model = t.Model WHERE split = 'test' GROUP BY 1, 2) JOIN (
  SELECT Model, (sum(CASE WHEN label = 1 THEN r END) - p * (p + 1) / 2) / (p * (n - p)) AS auc
  FROM (SELECT Model, label, rank() OVER (PARTITION BY Model ORDER BY score)
               + (count(*) OVER (PARTITION BY Model, score) - 1) / 2.0::DOUBLE AS r,
               sum(label) OVER (PARTITION BY Model) AS p, count(*) OVER (PARTITION BY Model) AS n
        FROM curve_scores WHERE split = 'test') GROUP BY Model, p, n) USING (Model)
"""


def with_views(sql: str) -> str:
    """Prefix a statement with the expressions it uses, dependencies first."""
    order: list[str] = []

    def visit(text: str) -> None:
        for name, body in VIEWS.items():
            if name not in order and re.search(rf"\b{name}\b", text):
                visit(body)
                if name not in order:
                    order.append(name)

    visit(sql)
    if not order:
        return sql.strip()
    parts = ",\n".join(f"{n} AS ({VIEWS[n].strip()})" for n in order)
    body = sql.strip()
    joiner = ",\n" if body.upper().startswith("WITH ") else "\n"
    return f"WITH {parts}{joiner}{body[5:] if joiner == ',' + chr(10) else body}"
