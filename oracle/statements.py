"""One statement per registered query."""

from __future__ import annotations

from oracle.views import with_views

SQL: dict[str, str] = {}

# --- cleaning and warehouse -------------------------------------------------------------------------------

SQL["cancellation_rate"] = """
SELECT count(*) AS TotalLines, CAST(sum(CASE WHEN upper(Invoice) LIKE 'C%' THEN 1 ELSE 0 END) AS BIGINT) AS CancelledLines,
       round(CAST(sum(CASE WHEN upper(Invoice) LIKE 'C%' THEN 1 ELSE 0 END) AS DOUBLE) * 100 / count(*), 6)
         AS CancelledPercent
FROM staging_retail
"""

SQL["clean_retail"] = """
SELECT Invoice, StockCode, CAST(CustomerID AS BIGINT) AS CustomerID, CAST(Quantity AS BIGINT) AS Quantity,
       CAST(Price AS DOUBLE) AS Price, Description, CAST(TotalPrice AS DOUBLE) AS TotalPrice, Country,
       CAST(InvoiceDay AS VARCHAR) AS InvoiceDay, CAST(Year AS BIGINT) AS Year, CAST(Month AS BIGINT) AS Month,
       DayOfWeek, CAST(Hour AS BIGINT) AS Hour, CAST(IsWeekend AS BIGINT) AS IsWeekend,
       CAST(Quarter AS BIGINT) AS Quarter, ProductCategory
FROM clean_retail
"""

SQL["duplicate_rows"] = """
SELECT CAST(sum(n) AS BIGINT) AS Rows, CAST(sum(n - 1) AS BIGINT) AS DuplicateRows
FROM (SELECT count(*) AS n FROM staging_retail
      GROUP BY Invoice, StockCode, Description, Quantity, InvoiceDate, Price, CustomerID, Country)
"""

SQL["clean_reviews"] = """
SELECT ReviewID, ClothingID, CAST(Age AS BIGINT) AS Age, Title, md5(ReviewText) AS TextDigest,
       CAST(Rating AS BIGINT) AS Rating, CAST(Recommended AS BIGINT) AS Recommended,
       CAST(PositiveFeedback AS BIGINT) AS PositiveFeedback, DivisionName, DepartmentName, ClassName,
       CAST(ReviewLength AS BIGINT) AS ReviewLength, CNN_Matched_Class
FROM clean_reviews
"""

SQL["dim_time"] = """
SELECT CAST(TimeID AS BIGINT) AS TimeID, CAST(FullDate AS VARCHAR) AS FullDate, CAST(Day AS BIGINT) AS Day, DayOfWeek,
       CAST(Month AS BIGINT) AS Month, MonthName, CAST(Quarter AS BIGINT) AS Quarter, CAST(Year AS BIGINT) AS Year,
       CAST(IsWeekend AS BIGINT) AS IsWeekend, CAST(IsHoliday AS BIGINT) AS IsHoliday
FROM dim_time
"""

SQL["dim_location"] = "SELECT CAST(LocationID AS BIGINT) AS LocationID, Country, Region, City FROM dim_location"

SQL["dim_product"] = """
SELECT CAST(ProductID AS BIGINT) AS ProductID, StockCode, ProductName, Category, SubCategory, AvgPrice, AvgRating,
       ImageCategory, PriceRange FROM dim_product
"""

SQL["fact_orders"] = """
SELECT OrderID, InvoiceNo, CAST(CustomerID AS BIGINT) AS CustomerID, CAST(ProductID AS BIGINT) AS ProductID,
       CAST(TimeID AS BIGINT) AS TimeID, CAST(LocationID AS BIGINT) AS LocationID, CAST(Quantity AS BIGINT) AS Quantity,
       CAST(UnitPrice AS DOUBLE) AS UnitPrice, CAST(TotalPrice AS DOUBLE) AS TotalPrice,
       CAST(Discount AS DOUBLE) AS Discount
FROM fact_orders
"""

SQL["fact_reviews"] = """
SELECT ReviewID, ClothingID, CAST(Rating AS BIGINT) AS Rating, Title, CAST(ReviewLength AS BIGINT) AS ReviewLength,
       CAST(Age AS BIGINT) AS Age, DivisionName, DepartmentName, ClassName, CNN_Matched_Class,
       CAST(Recommended AS BIGINT) AS Recommended, CAST(PositiveFeedback AS BIGINT) AS PositiveFeedback,
       CAST(NULL AS DOUBLE) AS SentimentScore
FROM clean_reviews
"""

SQL["category_distribution"] = """
SELECT ProductCategory, count(*) AS TotalRows,
       round(CAST(count(*) AS DOUBLE) * 100 / (SELECT count(*) FROM clean_retail), 6) AS Percentage
FROM clean_retail GROUP BY ProductCategory
"""

SQL["etl_reconciliation"] = """
SELECT Stage, SourceRows, LoadedRows, SourceRows - LoadedRows AS RowsLost,
       round(CAST(LoadedRows AS DOUBLE) * 100 / SourceRows, 6) AS LoadPercent
FROM (SELECT 'Fact_Orders' AS Stage, (SELECT count(*) FROM clean_retail) AS SourceRows,
             (SELECT count(*) FROM fact_orders) AS LoadedRows
      UNION ALL SELECT 'Fact_Reviews', (SELECT count(*) FROM clean_reviews), (SELECT count(*) FROM clean_reviews)
      UNION ALL SELECT 'clean_retail', (SELECT count(*) FROM staging_retail), (SELECT count(*) FROM clean_retail))
"""

SQL["cleaning_steps"] = """
WITH flags AS (SELECT upper(Invoice) NOT LIKE 'C%' AS kept, CustomerID IS NOT NULL AS known,
                      Quantity > 0 AND Price > 0 AS valid FROM staging_retail)
SELECT '1 raw' AS Step, count(*) AS RowsLeft FROM flags
UNION ALL SELECT '2 not cancelled', count(*) FROM flags WHERE kept
UNION ALL SELECT '3 known customer', count(*) FROM flags WHERE kept AND known
UNION ALL SELECT '4 positive amounts', count(*) FROM flags WHERE kept AND known AND valid
UNION ALL SELECT '5 no duplicates', count(*) FROM clean_retail
"""

SQL["table_counts"] = """
SELECT 'Dim_Customer' AS TableName, count(*) AS TotalRows FROM dim_customer
UNION ALL SELECT 'Dim_Location', count(*) FROM dim_location
UNION ALL SELECT 'Dim_Product', count(*) FROM dim_product
UNION ALL SELECT 'Dim_Time', count(*) FROM dim_time
UNION ALL SELECT 'Fact_Orders', count(*) FROM fact_orders
UNION ALL SELECT 'Fact_Reviews', count(*) FROM clean_reviews
UNION ALL SELECT 'final_customer_dataset', count(*) FROM final_customer_dataset
"""

SQL["fk_orphans"] = """
SELECT 'CustomerID' AS ForeignKey, count(*) AS Orphans FROM fact_orders
 WHERE CustomerID NOT IN (SELECT CustomerID FROM dim_customer)
UNION ALL SELECT 'LocationID', count(*) FROM fact_orders WHERE LocationID NOT IN (SELECT LocationID FROM dim_location)
UNION ALL SELECT 'ProductID', count(*) FROM fact_orders WHERE ProductID NOT IN (SELECT ProductID FROM dim_product)
UNION ALL SELECT 'TimeID', count(*) FROM fact_orders WHERE TimeID NOT IN (SELECT TimeID FROM dim_time)
"""

SQL["null_checks"] = """
SELECT 'TotalItems' AS "Column", count(*) - count(TotalItems) AS Nulls FROM final_customer_dataset
UNION ALL SELECT 'Region', count(*) - count(Region) FROM final_customer_dataset
UNION ALL SELECT 'Country', count(*) - count(Country) FROM final_customer_dataset
UNION ALL SELECT 'ChurnLabel', count(*) - count(ChurnLabel) FROM final_customer_dataset
"""

SQL["row_integrity"] = """
SELECT e AS Expected, a AS Actual, CASE WHEN e = a THEN 'PASS' ELSE 'FAIL' END AS Status
FROM (SELECT (SELECT count(*) FROM dim_customer) AS e, (SELECT count(*) FROM final_customer_dataset) AS a)
"""

# --- customer features -------------------------------------------------------------------------------------

SQL["rfm"] = """
SELECT CAST(CustomerID AS BIGINT) AS CustomerID, CAST(Recency AS BIGINT) AS Recency, Frequency,
       CAST(Monetary AS DOUBLE) AS Monetary, CAST(JoinDate AS VARCHAR) AS JoinDate, AvgOrderValue,
       CAST(ChurnLabel AS BIGINT) AS ChurnLabel
FROM rfm_table
"""

SQL["churn_summary"] = """
SELECT CAST(sum(ChurnLabel) AS BIGINT) AS Churned, CAST(sum(1 - ChurnLabel) AS BIGINT) AS Active,
       round(CAST(sum(ChurnLabel) AS DOUBLE) * 100 / count(*), 6) AS ChurnRatePercent
FROM rfm_table
"""

SQL["churn_label_recency90"] = """
SELECT CAST(CustomerID AS BIGINT) AS CustomerID,
       CAST(floor((epoch(m.t) + 86400 - epoch(last_ts)) / 86400) AS BIGINT) AS Recency, Frequency,
       CAST(Monetary AS DOUBLE) AS Monetary,
       CAST(CASE WHEN floor((epoch(m.t) + 86400 - epoch(last_ts)) / 86400) > 90 THEN 1 ELSE 0 END AS BIGINT)
         AS ChurnLabel
FROM rfm_base, (SELECT max(InvoiceDate) AS t FROM clean_retail) m
"""

SQL["modal_country"] = "SELECT CAST(CustomerID AS BIGINT) AS CustomerID, Country FROM modal_country"

SQL["favorite_product"] = "SELECT CAST(CustomerID AS BIGINT) AS CustomerID, FavoriteProduct FROM favourite_product"

SQL["tenure_features"] = """
SELECT CAST(CustomerID AS BIGINT) AS CustomerID, CAST(min(InvoiceDay) AS VARCHAR) AS FirstPurchase,
       CAST(max(InvoiceDay) AS VARCHAR) AS LastPurchase, CAST(sum(Quantity) AS BIGINT) AS TotalItems,
       count(DISTINCT StockCode) AS UniqueProducts, count(DISTINCT Country) AS UniqueCountries,
       CAST(datediff('day', min(InvoiceDay), (SELECT max(InvoiceDay) + 1 FROM clean_retail)) AS BIGINT)
         AS DaysSinceFirstPurchase,
       CAST(datediff('day', min(InvoiceDay), max(InvoiceDay)) AS BIGINT) AS CustomerLifespan
FROM clean_retail GROUP BY CustomerID
"""

SQL["customer_features"] = """
SELECT CAST(b.CustomerID AS BIGINT) AS CustomerID, CAST(Recency AS BIGINT) AS Recency, Frequency,
       CAST(Monetary AS DOUBLE) AS Monetary, CAST(Monetary AS DOUBLE) / Frequency AS AvgOrderValue,
       CAST(CASE WHEN Recency > 90 THEN 1 ELSE 0 END AS BIGINT) AS ChurnLabel, t.TotalItems, t.UniqueProducts,
       CAST(datediff('day', t.f, (SELECT max(InvoiceDay) + 1 FROM clean_retail)) AS BIGINT) AS DaysSinceFirstPurchase,
       CAST(datediff('day', t.f, t.l) AS BIGINT) AS CustomerLifespan, FavoriteProduct, Country
FROM rfm_base b JOIN (SELECT CustomerID, min(InvoiceDay) AS f, max(InvoiceDay) AS l,
                             CAST(sum(Quantity) AS BIGINT) AS TotalItems, count(DISTINCT StockCode) AS UniqueProducts
                      FROM clean_retail GROUP BY CustomerID) t USING (CustomerID)
     LEFT JOIN favourite_product USING (CustomerID) LEFT JOIN modal_country USING (CustomerID)
"""

SQL["dim_customer"] = """
SELECT CAST(CustomerID AS BIGINT) AS CustomerID, Country, AgeGroup, CAST(JoinDate AS VARCHAR) AS JoinDate,
       CAST(Recency AS BIGINT) AS Recency, Frequency, CAST(Monetary AS DOUBLE) AS Monetary, AvgOrderValue,
       RFM_Segment, CAST(ChurnLabel AS BIGINT) AS ChurnLabel
FROM dim_customer
"""

SQL["final_customer_dataset"] = """
SELECT CAST(CustomerID AS BIGINT) AS CustomerID, Country, CAST(JoinDate AS VARCHAR) AS JoinDate,
       CAST(Recency AS BIGINT) AS Recency, Frequency, CAST(Monetary AS DOUBLE) AS Monetary, AvgOrderValue,
       CAST(ChurnLabel AS BIGINT) AS ChurnLabel, CAST(TotalItems AS BIGINT) AS TotalItems, UniqueProducts, TotalOrders,
       CAST(FirstOrderDate AS VARCHAR) AS FirstOrderDate, CAST(LastOrderDate AS VARCHAR) AS LastOrderDate,
       CAST(CustomerLifespanDays AS BIGINT) AS CustomerLifespanDays, Region, AvgQuantityPerOrder, AvgPricePerItem
FROM final_customer_dataset
"""

SQL["customer_orders_line_variant"] = """
SELECT CAST(CustomerID AS BIGINT) AS CustomerID, CAST(sum(Quantity) AS BIGINT) AS TotalItems,
       count(DISTINCT ProductID) AS UniqueProducts, count(DISTINCT InvoiceNo) AS TotalOrders,
       CAST(min(FullDate) AS VARCHAR) AS FirstOrderDate, CAST(max(FullDate) AS VARCHAR) AS LastOrderDate,
       CAST(sum(Quantity) AS DOUBLE) / count(*) AS AvgQuantityPerOrder,
       CAST(sum(UnitPrice) AS DOUBLE) / count(*) AS AvgPricePerItem
FROM star GROUP BY CustomerID
"""

SQL["behavior_features"] = """
SELECT CAST(CustomerID AS BIGINT) AS CustomerID, CategoryDiversity, round(WeekendRatio, 6) AS WeekendRatio,
       round(PremiumRatio, 6) AS PremiumRatio, CAST(LastPurchaseMonth AS BIGINT) AS LastPurchaseMonth,
       round(SpendingStdDev, 2) AS SpendingStdDev
FROM behaviour_features
"""

SQL["rfm_by_churn"] = """
WITH long AS (
  SELECT ChurnLabel, 'Recency' AS Feature, CAST(Recency AS DOUBLE) AS v FROM rfm_table
  UNION ALL SELECT ChurnLabel, 'Frequency', CAST(Frequency AS DOUBLE) FROM rfm_table
  UNION ALL SELECT ChurnLabel, 'Monetary', CAST(Monetary AS DOUBLE) FROM rfm_table)
SELECT CAST(ChurnLabel AS BIGINT) AS ChurnLabel, Feature, round(avg(v), 6) AS Mean, min(v) AS Min,
       round(quantile_cont(v, 0.5), 6) AS Median, max(v) AS Max
FROM long GROUP BY ChurnLabel, Feature
"""

# --- reports -----------------------------------------------------------------------------------------------

SQL["top_products"] = """
SELECT CAST(ProductID AS BIGINT) AS ProductID, ProductName, Category, CAST(sum(Quantity) AS BIGINT) AS TotalUnitsSold,
       CAST(sum(TotalPrice) AS DOUBLE) AS TotalRevenue, count(*) AS TimesOrdered
FROM star GROUP BY ProductID, ProductName, Category ORDER BY TotalUnitsSold DESC, ProductID LIMIT 10
"""

SQL["monthly_revenue"] = """
SELECT CAST(Year AS BIGINT) AS Year, CAST(Month AS BIGINT) AS Month, MonthName, CAST(sum(TotalPrice) AS DOUBLE) AS Revenue,
       count(DISTINCT InvoiceNo) AS TotalOrders, count(DISTINCT CustomerID) AS UniqueCustomers
FROM star GROUP BY 1, 2, 3
"""

SQL["revenue_by_country"] = """
SELECT Country, CAST(sum(TotalPrice) AS DOUBLE) AS TotalRevenue, count(DISTINCT CustomerID) AS UniqueCustomers,
       count(DISTINCT InvoiceNo) AS TotalOrders
FROM star GROUP BY Country ORDER BY TotalRevenue DESC, Country LIMIT 10
"""

SQL["sales_by_weekday"] = """
SELECT d.DayOfWeek, TotalOrders, TotalRevenue, AvgOrderValue
FROM (SELECT unnest(['Monday', 'Tuesday', 'Wednesday', 'Thursday', 'Friday', 'Saturday', 'Sunday']) AS DayOfWeek) d
LEFT JOIN (SELECT DayOfWeek, count(DISTINCT InvoiceNo) AS TotalOrders, CAST(sum(TotalPrice) AS DOUBLE) AS TotalRevenue,
                  round(CAST(sum(TotalPrice) AS DOUBLE) / count(*), 6) AS AvgOrderValue
           FROM star GROUP BY DayOfWeek) s ON d.DayOfWeek = s.DayOfWeek
"""

SQL["products_by_price_band"] = """
SELECT PriceRange, count(*) AS ProductCount, round(avg(AvgRating), 6) AS AvgRating FROM dim_product GROUP BY PriceRange
"""

SQL["region_share"] = """
SELECT Region, CAST(sum(TotalPrice) AS DOUBLE) AS Revenue, count(*) AS Orders,
       round(CAST(sum(TotalPrice) AS DOUBLE) * 100 / (SELECT CAST(sum(TotalPrice) AS DOUBLE) FROM star), 6) AS Pct
FROM star GROUP BY Region
"""

SQL["daily_revenue"] = """
SELECT CAST(FullDate AS VARCHAR) AS FullDate, CAST(sum(TotalPrice) AS DOUBLE) AS Revenue, count(*) AS Orders
FROM star GROUP BY FullDate
"""

SQL["monthly_change"] = """
SELECT Month, Revenue, round((Revenue / lag(Revenue) OVER (ORDER BY Month) - 1) * 100, 6) AS Change
FROM (SELECT strftime(FullDate, '%Y-%m') AS Month, CAST(sum(TotalPrice) AS DOUBLE) AS Revenue FROM star GROUP BY 1)
"""

SQL["quarterly_growth"] = """
SELECT Quarter, Revenue, round((Revenue / lag(Revenue) OVER (ORDER BY Quarter) - 1) * 100, 6) AS GrowthRate
FROM (SELECT concat(CAST(Year AS VARCHAR), 'Q', CAST(Quarter AS VARCHAR)) AS Quarter,
             CAST(sum(TotalPrice) AS DOUBLE) AS Revenue FROM star GROUP BY 1)
"""

SQL["category_revenue"] = """
WITH top AS (SELECT Category, CAST(sum(TotalPrice) AS DOUBLE) AS Revenue FROM star GROUP BY Category
             ORDER BY Revenue DESC, Category LIMIT 8)
SELECT Category, Revenue, round(Revenue * 100 / (SELECT sum(Revenue) FROM top), 6) AS Share FROM top
"""

SQL["lines_by_price_band"] = """
SELECT PriceRange, count(*) AS Lines, round(CAST(count(*) AS DOUBLE) * 100 / (SELECT count(*) FROM star), 6) AS Percent
FROM star GROUP BY PriceRange
"""

SQL["weekend_split"] = """
SELECT CASE WHEN IsWeekend = 1 THEN 'Weekend' ELSE 'Weekday' END AS Label, CAST(sum(TotalPrice) AS DOUBLE) AS Revenue,
       count(*) AS Lines,
       round(CAST(sum(TotalPrice) AS DOUBLE) * 100 / (SELECT CAST(sum(TotalPrice) AS DOUBLE) FROM star), 6) AS Percent
FROM star GROUP BY 1
"""

SQL["category_quantity"] = """
SELECT Category, CAST(sum(Quantity) AS BIGINT) AS Quantity,
       round(CAST(sum(Quantity) AS DOUBLE) * 100 / (SELECT CAST(sum(Quantity) AS DOUBLE) FROM star), 6) AS Percent
FROM star GROUP BY Category ORDER BY Quantity DESC, Category LIMIT 10
"""

SQL["purchase_frequency"] = """
WITH binned AS (SELECT CASE WHEN Frequency > 0 AND Frequency <= 1 THEN '1 order' WHEN Frequency > 1 AND Frequency <= 3 THEN '2-3'
    WHEN Frequency > 3 AND Frequency <= 5 THEN '4-5' WHEN Frequency > 5 AND Frequency <= 10 THEN '6-10'
    WHEN Frequency > 10 AND Frequency <= 50 THEN '11-50' WHEN Frequency > 50 AND Frequency <= 1000 THEN '50+' END AS b
  FROM dim_customer)
SELECT l.FreqBin, count(b) AS Customers,
       round(CAST(count(b) AS DOUBLE) * 100 / (SELECT count(*) FROM dim_customer), 6) AS Percent
FROM (SELECT unnest(['1 order', '2-3', '4-5', '6-10', '11-50', '50+']) AS FreqBin) l LEFT JOIN binned ON l.FreqBin = b
GROUP BY l.FreqBin
"""

SQL["rating_distribution"] = """
SELECT CAST(Rating AS BIGINT) AS Rating, count(*) AS Reviews,
       round(CAST(count(*) AS DOUBLE) * 100 / (SELECT count(*) FROM clean_reviews), 6) AS Percent
FROM clean_reviews WHERE Rating IS NOT NULL GROUP BY Rating
"""

SQL["recommend_rate_by_class"] = """
SELECT ClassName, count(Recommended) AS Total, CAST(sum(Recommended) AS BIGINT) AS Recommended,
       round(CAST(sum(Recommended) AS DOUBLE) * 100 / count(Recommended), 6) AS Percent
FROM clean_reviews GROUP BY ClassName
"""

SQL["age_rating_matrix"] = """
SELECT AgeGroup, count(*) FILTER (Rating = 1) AS Rating_1, count(*) FILTER (Rating = 2) AS Rating_2,
       count(*) FILTER (Rating = 3) AS Rating_3, count(*) FILTER (Rating = 4) AS Rating_4,
       count(*) FILTER (Rating = 5) AS Rating_5
FROM (SELECT Rating, CASE WHEN Age > 17 AND Age <= 25 THEN '18-25' WHEN Age > 25 AND Age <= 35 THEN '26-35'
             WHEN Age > 35 AND Age <= 45 THEN '36-45' WHEN Age > 45 AND Age <= 55 THEN '46-55'
             WHEN Age > 55 AND Age <= 100 THEN '56+' END AS AgeGroup FROM clean_reviews)
WHERE AgeGroup IS NOT NULL AND Rating IS NOT NULL GROUP BY AgeGroup
"""

SQL["top_customers"] = """
SELECT CAST(CustomerID AS BIGINT) AS CustomerID, Country, CAST(Recency AS BIGINT) AS Recency, Frequency,
       CAST(Monetary AS DOUBLE) AS Monetary, AvgOrderValue,
       CASE WHEN ChurnLabel = 1 THEN 'Churned' ELSE 'Active' END AS Status
FROM dim_customer ORDER BY dim_customer.Monetary DESC, dim_customer.CustomerID LIMIT 10
"""

SQL["products_per_category"] = """
SELECT Category, count(*) AS Count, round(CAST(count(*) AS DOUBLE) * 100 / (SELECT count(*) FROM dim_product), 6) AS Percent
FROM dim_product GROUP BY Category
"""

SQL["kpi_summary"] = """
SELECT (SELECT count(*) FROM dim_customer) AS Customers, (SELECT count(*) FROM dim_product) AS Products,
       (SELECT count(*) FROM fact_orders) AS OrderLines, (SELECT count(*) FROM clean_reviews) AS Reviews,
       (SELECT CAST(sum(TotalPrice) AS DOUBLE) FROM fact_orders) AS Revenue
"""

SQL["warehouse_preview"] = """
SELECT InvoiceNo, CAST(CustomerID AS BIGINT) AS CustomerID, ProductName, CAST(FullDate AS VARCHAR) AS FullDate, Country,
       CAST(Quantity AS BIGINT) AS Quantity, CAST(TotalPrice AS DOUBLE) AS TotalPrice
FROM star ORDER BY InvoiceNo, OrderID LIMIT 10
"""

SQL["recency_monetary_sample"] = """
SELECT CAST(CustomerID AS BIGINT) AS CustomerID, CAST(Recency AS BIGINT) AS Recency, CAST(Monetary AS DOUBLE) AS Monetary,
       CAST(ChurnLabel AS BIGINT) AS ChurnLabel
FROM dim_customer ORDER BY md5(concat_ws('|', '42', CAST(dim_customer.CustomerID AS VARCHAR))), dim_customer.CustomerID
LIMIT 2000
"""

# --- baskets -----------------------------------------------------------------------------------------------

SQL["basket_items"] = "SELECT InvoiceNo, Item FROM basket_items"

SQL["frequent_itemsets"] = """
SELECT Items, freq, round(Support, 6) AS Support, CAST(Length AS BIGINT) AS Length FROM itemsets
"""

SQL["association_rules"] = """
SELECT Antecedent, Consequent, round(Support, 6) AS Support, round(Confidence, 6) AS Confidence, round(Lift, 6) AS Lift
FROM basket_rules
"""

SQL["strong_rules"] = """
SELECT Antecedent, Consequent, round(Lift, 6) AS Lift FROM basket_rules WHERE Confidence >= 0.08 AND basket_rules.Lift >= 1.2
"""

SQL["itemset_summary"] = """
SELECT count(*) AS Itemsets, CAST(sum((Length = 1)::INT) AS BIGINT) AS Singles, CAST(sum((Length = 2)::INT) AS BIGINT) AS Pairs,
       CAST(sum((Length >= 3)::INT) AS BIGINT) AS TriplesOrMore, round(min(Support), 6) AS MinSupport,
       round(max(Support), 6) AS MaxSupport, round(median(Support), 6) AS MedianSupport
FROM itemsets
"""

SQL["rule_summary"] = """
SELECT count(*) AS Rules, CAST(sum((Confidence >= 0.08)::INT) AS BIGINT) AS HighConfidence,
       CAST(sum((Lift >= 1.2)::INT) AS BIGINT) AS StrongLift, round(avg(Confidence), 6) AS AvgConfidence,
       round(max(Lift), 6) AS MaxLift,
       (SELECT concat(Antecedent, ' -> ', Consequent) FROM basket_rules
        ORDER BY Lift DESC, Confidence DESC, Antecedent DESC, Consequent DESC LIMIT 1) AS StrongestRule
FROM basket_rules
"""

SQL["pair_cooccurrence"] = """
SELECT a.Description AS ItemA, b.Description AS ItemB, count(*) AS CoOccurrence
FROM clean_retail a JOIN clean_retail b ON a.Invoice = b.Invoice AND a.Description < b.Description
GROUP BY 1, 2 HAVING count(*) > 5 ORDER BY CoOccurrence DESC, ItemA, ItemB LIMIT 20
"""

SQL["product_pairs"] = """
SELECT CAST(a.ProductID AS BIGINT) AS Product_A, a.ProductName AS ProductName_A, CAST(b.ProductID AS BIGINT) AS Product_B,
       b.ProductName AS ProductName_B, count(*) AS CoOccurrence
FROM star a JOIN star b ON a.InvoiceNo = b.InvoiceNo AND a.ProductID < b.ProductID
GROUP BY 1, 2, 3, 4 ORDER BY CoOccurrence DESC, Product_A, Product_B LIMIT 20
"""

# --- sentiment ---------------------------------------------------------------------------------------------

SQL["clean_text"] = r"""
SELECT page_id, md5(trim(regexp_replace(regexp_replace(regexp_replace(regexp_replace(html, '<[^>]+>', '', 'g'),
         'http\S+|www\S+', '', 'g'), '[^\p{L}\p{N}_\s\p{Z}.,!?''-]', '', 'g'), '[\s\p{Z}]+', ' ', 'g'))) AS CleanDigest
FROM pages
"""

SQL["review_word_counts"] = r"""
SELECT ReviewID, CAST(length(ReviewText) - length(replace(ReviewText, ' ', '')) + 1 AS BIGINT) AS Spaces,
       CAST(len(list_filter(regexp_split_to_array(ReviewText, '\s+'), lambda t: t <> '')) AS BIGINT) AS Tokens
FROM clean_reviews
"""

SQL["lexicon_sentiment"] = """
SELECT ReviewID, round(VADER_Score, 6) AS VADER_Score, VADER_Label, round(TextBlob_Score, 6) AS TextBlob_Score,
       round(TextBlob_Subjectivity, 6) AS TextBlob_Subjectivity, TextBlob_Label
FROM scored_reviews
"""

SQL["sentiment_ensemble"] = """
SELECT ReviewID, round(Ensemble_Score, 6) AS Ensemble_Score, Final_Sentiment FROM scored_reviews
"""

SQL["sentiment_by_class"] = """
SELECT CNN_Matched_Class, round(avg(Ensemble_Score), 6) AS Avg_Sentiment, round(avg(Rating), 6) AS Avg_Rating,
       count(*) AS Total_Reviews,
       round(avg(CASE WHEN Final_Sentiment = 'Positive' THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END) * 100, 6) AS Positive_Pct
FROM scored_reviews GROUP BY CNN_Matched_Class
"""

SQL["sentiment_label_shares"] = """
SELECT Scorer, Label, count(*) AS Reviews,
       round(count(*)::DOUBLE * 100 / (SELECT count(*) FROM scored_reviews), 6) AS Percent
FROM (SELECT 'VADER_Label' AS Scorer, VADER_Label AS Label FROM scored_reviews
      UNION ALL SELECT 'TextBlob_Label', TextBlob_Label FROM scored_reviews
      UNION ALL SELECT 'Final_Sentiment', Final_Sentiment FROM scored_reviews) GROUP BY 1, 2
"""

SQL["sentiment_summary"] = """
SELECT count(*) AS Reviews, round(avg(VADER_Score), 6) AS AvgVader, round(avg(TextBlob_Score), 6) AS AvgTextBlob,
       round(avg(Ensemble_Score), 6) AS AvgEnsemble, round(corr(VADER_Score, TextBlob_Score), 6) AS CorrScorers,
       round(corr(Ensemble_Score, Rating), 6) AS CorrRating
FROM scored_reviews
"""

SQL["sentiment_by_category"] = """
SELECT CNN_Matched_Class AS Category, round(avg(Ensemble_Score), 6) AS AvgSentiment, round(avg(Rating), 6) AS AvgRating,
       count(*) AS ReviewCount, CAST(sum(Recommended) AS BIGINT) AS RecommendedCount,
       round(CAST(sum(Recommended) AS DOUBLE) * 100 / count(*), 6) AS RecommendRatePercent,
       round(avg(CASE WHEN Ensemble_Score > 0.05 THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END) * 100, 6) AS PositivePercent
FROM scored_reviews GROUP BY CNN_Matched_Class
"""

SQL["sentiment_by_department"] = """
SELECT DepartmentName, round(avg(Ensemble_Score), 6) AS AvgSentiment FROM scored_reviews GROUP BY DepartmentName
"""

SQL["sentiment_by_rating"] = """
SELECT CAST(Rating AS BIGINT) AS Rating, round(avg(Ensemble_Score), 6) AS Mean, round(stddev_samp(Ensemble_Score), 6) AS Std
FROM scored_reviews GROUP BY 1
"""

SQL["sentiment_write_back"] = """
SELECT ReviewID, CAST(Rating AS BIGINT) AS Rating, round(Ensemble_Score, 6) AS SentimentScore FROM scored_reviews
"""

# --- recommendations ---------------------------------------------------------------------------------------

SQL["user_item_weights"] = """
SELECT CAST(CustomerID AS BIGINT) AS CustomerID, StockCode, CAST(TotalQty AS BIGINT) AS TotalQty, round(Weight, 6) AS Weight
FROM triples
"""

SQL["user_item_summary"] = """
SELECT u AS Users, i AS Items, n AS NonZero, round(100.0::DOUBLE - n::DOUBLE * 100 / (u * i), 6) AS SparsityPercent
FROM (SELECT count(DISTINCT CustomerID) AS u, count(DISTINCT StockCode) AS i, count(*) AS n FROM triples)
"""

SQL["similarity_summary"] = """
SELECT n AS Users, round((SELECT sum(d / (a.n * b.n))
    FROM (SELECT x.CustomerID AS u, y.CustomerID AS v, sum(x.Weight * y.Weight) AS d
          FROM triples x JOIN triples y ON x.StockCode = y.StockCode AND x.CustomerID < y.CustomerID GROUP BY 1, 2)
         JOIN norms a ON u = a.CustomerID JOIN norms b ON v = b.CustomerID) / (n * (n - 1) / 2), 6) AS MeanSimilarity
FROM (SELECT count(*) AS n FROM norms)
"""

SQL["user_similarity_topk"] = """
SELECT CAST(u AS BIGINT) AS CustomerID, CAST(v AS BIGINT) AS NeighbourID, round(sim, 6) AS Similarity,
       CAST(rn AS BIGINT) AS Rank
FROM nearest
"""

SQL["collab_recs"] = """
SELECT CAST(CustomerID AS BIGINT) AS CustomerID, o.StockCode, ProductName, round(score, 6) AS Collaborative_Score,
       CAST(rn AS BIGINT) AS Rank
FROM offers o JOIN best_items USING (StockCode) WHERE rn <= 5
"""

SQL["category_content_profile"] = """
WITH p AS (SELECT CNN_Matched_Class, avg(Ensemble_Score) AS s, avg(Rating) AS r, avg(Recommended) AS c,
                  avg(PositiveFeedback) AS f, count(*) AS n FROM scored_reviews GROUP BY 1),
     q AS (SELECT *, coalesce(s, 0) * 0.3 + r / 5.0 * 0.3 + coalesce(c, 0) * 0.2 + f / max(f) OVER () * 0.2 AS score FROM p)
SELECT CNN_Matched_Class, round(s, 6) AS Avg_Sentiment, round(r, 6) AS Avg_Rating, round(c, 6) AS Recommend_Rate,
       round(f, 6) AS Avg_Feedback, n AS Total_Reviews, round(score, 6) AS Content_Score,
       round((score - min(score) OVER ()) / (max(score) OVER () - min(score) OVER ()), 6) AS Content_Score_Normalized
FROM q
"""

SQL["content_recs"] = """
SELECT CNN_Matched_Class, ClassName, round(Avg_Rating, 6) AS Avg_Rating, Review_Count, round(Item_Score, 6) AS Item_Score,
       CAST(rn AS BIGINT) AS Rank
FROM class_items WHERE rn <= 5
"""

SQL["imputed_sentiment"] = """
SELECT ReviewID, CAST(Rating AS BIGINT) AS Rating, greatest(-1.0::DOUBLE, least(1.0::DOUBLE, (Rating - 3)::DOUBLE / 2)) AS SentimentScore
FROM clean_reviews
"""

SQL["hybrid_recs"] = """
WITH mass AS (SELECT u, sum(sim) AS m FROM nearest GROUP BY u),
     named AS (SELECT CustomerID, ProductName, arg_max(score, rn) AS score FROM offers JOIN best_items USING (StockCode)
               WHERE rn <= 10 GROUP BY 1, 2),
     top3 AS (SELECT *, max(Item_Score) OVER (PARTITION BY CNN_Matched_Class) AS hi,
                     min(Item_Score) OVER (PARTITION BY CNN_Matched_Class) AS lo FROM class_items WHERE rn <= 3),
     pool AS (
       SELECT r.CustomerID, r.CNN_Matched_Class, ProductName AS Product,
              greatest(0.0::DOUBLE, least(1.0::DOUBLE, coalesce(score / m, 0))) * 0.6 AS Collaborative,
              0.0::DOUBLE AS Content, 'Collaborative' AS Source
       FROM requests r JOIN named USING (CustomerID) LEFT JOIN mass ON u = r.CustomerID
       UNION ALL
       SELECT r.CustomerID, r.CNN_Matched_Class, concat(ClassName, ' (', r.CNN_Matched_Class, ')'), 0.0::DOUBLE,
              CASE WHEN hi = lo THEN 0.0::DOUBLE ELSE (Item_Score - lo) / (hi - lo) END * 0.4, 'Content-Based (CNN)'
       FROM requests r JOIN top3 USING (CNN_Matched_Class)),
     ranked AS (SELECT *, round(Collaborative + Content, 9) AS h,
                       row_number() OVER (PARTITION BY CustomerID, CNN_Matched_Class
                                          ORDER BY round(Collaborative + Content, 9) DESC, Product) AS rn FROM pool)
SELECT CAST(CustomerID AS BIGINT) AS CustomerID, CNN_Matched_Class, Product, round(Collaborative, 6) AS Collaborative,
       round(Content, 6) AS Content, Source, round(h, 6) AS Hybrid_Score, CAST(rn AS BIGINT) AS Rank
FROM ranked WHERE rn <= 5
"""

# --- profiling ---------------------------------------------------------------------------------------------

COLUMNS = {
    "dim_product": "ProductID:bigint StockCode:string ProductName:string Category:string SubCategory:string AvgPrice:double AvgRating:double ImageCategory:string PriceRange:string",
    "dim_customer": "CustomerID:bigint Country:string AgeGroup:string JoinDate:date Recency:int Frequency:bigint Monetary:decimal AvgOrderValue:double RFM_Segment:string ChurnLabel:int",
    "fact_orders": "OrderID:string InvoiceNo:string CustomerID:bigint ProductID:bigint TimeID:bigint LocationID:bigint Quantity:int UnitPrice:decimal TotalPrice:decimal Discount:decimal",
    "staging_reviews": "ReviewID:bigint ClothingID:bigint Age:int Title:string ReviewText:string Rating:int Recommended:int PositiveFeedback:int DivisionName:string DepartmentName:string ClassName:string",
}


def _columns(view: str) -> list[tuple[int, str, str]]:
    return [(i, *c.split(":")) for i, c in enumerate(COLUMNS[view].split())]


def _profile(view: str, title: str) -> str:
    return "\nUNION ALL ".join(
        f"""SELECT '{title}' AS TableName, CAST({i} AS BIGINT) AS Position, '{c}' AS "Column", '{kind}' AS Type, count({c}) AS NonNull, count(*) - count({c}) AS Nulls,
       count(DISTINCT {c}) AS DistinctValues, min(CAST({c} AS VARCHAR)) AS MinText, max(CAST({c} AS VARCHAR)) AS MaxText FROM {view}"""
        for i, c, kind in _columns(view)
    )


SQL["table_profile"] = _profile("dim_product", "Dim_Product")

SQL["review_profile"] = _profile("staging_reviews", "staging_reviews")

SQL["schema_listing"] = "\nUNION ALL ".join(
    f"""SELECT '{view}' AS TableName, CAST({i} AS BIGINT) AS Position, '{c}' AS "Column", count({c}) AS NonNull FROM {view}"""
    for view in ("dim_product", "dim_customer", "fact_orders")
    for i, c, _ in _columns(view)
)

SQL["null_checks_reviews"] = """
SELECT 'Title' AS "Column", count(*) - count(Title) AS Nulls FROM staging_reviews
UNION ALL SELECT 'ReviewText', count(*) - count(ReviewText) FROM staging_reviews
UNION ALL SELECT 'DepartmentName', count(*) - count(DepartmentName) FROM staging_reviews
"""

SQL["fk_orphans_partial"] = """
SELECT 'CustomerID' AS ForeignKey, count(*) AS Orphans FROM fact_orders WHERE CAST(CustomerID AS BIGINT) % 10 = 0
UNION ALL SELECT 'ProductID', count(*) FROM fact_orders JOIN dim_product USING (ProductID) WHERE Category = 'Jewellery'
"""

SQL["category_itemsets"] = """
SELECT array_to_string(items, ', ') AS Items, freq, round(Support, 6) AS Support, Length FROM category_sets
"""

SQL["category_rules"] = """
SELECT array_to_string(a.items, ', ') AS Antecedent, array_to_string(c.items, ', ') AS Consequent, round(s.Support, 6) AS Support,
       round(s.freq::DOUBLE / a.freq, 6) AS Confidence, round((s.freq::DOUBLE / a.freq) / (c.freq::DOUBLE / s.n), 6) AS Lift
FROM category_sets s JOIN category_sets a ON list_has_all(s.items, a.items) AND a.Length < s.Length
     JOIN category_sets c ON list_has_all(s.items, c.items) AND c.Length = s.Length - a.Length AND NOT list_has_any(a.items, c.items)
WHERE s.freq::DOUBLE / a.freq >= 0.3
"""

SQL["display_customers"] = """
SELECT CAST(CustomerID AS BIGINT) AS CustomerID, substr(Country, 1, 12) AS CountryLabel,
       concat('$', format('{:,}', CAST(CAST(Monetary AS DECIMAL(20,0)) AS BIGINT))) AS MonetaryText,
       concat(Country, ' (', printf('%.1f', Monetary::DOUBLE * 100 / sum(Monetary::DOUBLE) OVER ()), '%)') AS ShareLabel
FROM (SELECT CustomerID, Country, Monetary FROM dim_customer ORDER BY Monetary DESC, CustomerID LIMIT 10)
"""

SQL["missing_table"] = """
SELECT c AS "Column", m AS Missing, round(m::DOUBLE * 100 / n, 6) AS Percent
FROM (SELECT unnest(['Title', 'ReviewText', 'DepartmentName']) AS c,
             unnest([count(*) - count(Title), count(*) - count(ReviewText), count(*) - count(DepartmentName)]) AS m,
             count(*) AS n FROM staging_reviews) WHERE m > 0
"""

SQL["describe_numeric"] = """
WITH long AS (SELECT 'Recency' AS c, CAST(Recency AS DOUBLE) AS v FROM rfm_table
              UNION ALL SELECT 'Frequency', CAST(Frequency AS DOUBLE) FROM rfm_table
              UNION ALL SELECT 'Monetary', CAST(Monetary AS DOUBLE) FROM rfm_table)
SELECT c AS "Column", count(v) AS Count, round(avg(v), 6) AS Mean, round(stddev_samp(v), 6) AS Std, min(v) AS Min,
       round(quantile_cont(v, 0.25), 6) AS P25, round(quantile_cont(v, 0.5), 6) AS P50,
       round(quantile_cont(v, 0.75), 6) AS P75, max(v) AS Max
FROM long GROUP BY c
"""

SQL["describe_lines"] = """
WITH long AS (SELECT 'Quantity' AS c, CAST(Quantity AS DOUBLE) AS v FROM clean_retail
              UNION ALL SELECT 'Price', CAST(Price AS DOUBLE) FROM clean_retail)
SELECT c AS "Column", count(v) AS Count, round(avg(v), 6) AS Mean, round(stddev_samp(v), 6) AS Std, min(v) AS Min,
       round(quantile_cont(v, 0.25), 6) AS P25, round(quantile_cont(v, 0.5), 6) AS P50,
       round(quantile_cont(v, 0.75), 6) AS P75, max(v) AS Max
FROM long GROUP BY c
"""

SQL["distinct_counts"] = """
SELECT 'CustomerID' AS "Column", count(DISTINCT CustomerID) AS DistinctValues, min(CAST(CAST(CustomerID AS BIGINT) AS VARCHAR)) AS MinText,
       max(CAST(CAST(CustomerID AS BIGINT) AS VARCHAR)) AS MaxText FROM clean_retail
UNION ALL SELECT 'StockCode', count(DISTINCT StockCode), min(StockCode), max(StockCode) FROM clean_retail
UNION ALL SELECT 'Country', count(DISTINCT Country), min(Country), max(Country) FROM clean_retail
UNION ALL SELECT 'Invoice', count(DISTINCT Invoice), min(Invoice), max(Invoice) FROM clean_retail
"""

SQL["iqr_filtered"] = """
WITH a AS (SELECT quantile_cont(Quantity::DOUBLE, 0.25) AS q1, quantile_cont(Quantity::DOUBLE, 0.75) AS q3 FROM clean_retail),
     b AS (SELECT c.* FROM clean_retail c, a
           WHERE Quantity BETWEEN q1 - (q3 - q1) * 1.5::DOUBLE AND q3 + (q3 - q1) * 1.5::DOUBLE),
     p AS (SELECT quantile_cont(Price::DOUBLE, 0.25) AS q1, quantile_cont(Price::DOUBLE, 0.75) AS q3 FROM b)
SELECT Invoice, StockCode, CAST(CustomerID AS BIGINT) AS CustomerID, CAST(Quantity AS BIGINT) AS Quantity,
       CAST(Price AS DOUBLE) AS Price
FROM b, p WHERE Price::DOUBLE BETWEEN q1 - (q3 - q1) * 1.5::DOUBLE AND q3 + (q3 - q1) * 1.5::DOUBLE
"""

SQL["winsorized_bounds"] = """
WITH long AS (SELECT 'Monetary' AS c, CAST(Monetary AS DOUBLE) AS v FROM final_customer_dataset
              UNION ALL SELECT 'Frequency', CAST(Frequency AS DOUBLE) FROM final_customer_dataset
              UNION ALL SELECT 'UniqueProducts', CAST(UniqueProducts AS DOUBLE) FROM final_customer_dataset
              UNION ALL SELECT 'AvgPricePerItem', AvgPricePerItem FROM final_customer_dataset),
     q AS (SELECT c, quantile_cont(v, 0.01) AS lo, quantile_cont(v, 0.99) AS hi FROM long GROUP BY c)
SELECT c AS "Column", round(lo, 6) AS Lower, round(hi, 6) AS Upper,
       CAST(sum((v < lo OR v > hi)::INT) AS BIGINT) AS Outside
FROM long JOIN q USING (c) GROUP BY c, lo, hi
"""

SQL["winsorized"] = """
SELECT CAST(CustomerID AS BIGINT) AS CustomerID, greatest(m1, least(m99, mo)) AS Monetary,
       greatest(f1, least(f99, fr)) AS Frequency, greatest(u1, least(u99, un)) AS UniqueProducts,
       greatest(p1, least(p99, AvgPricePerItem)) AS AvgPricePerItem
FROM churn_wide, churn_limits
"""

SQL["median_filled"] = """
SELECT ReviewID, coalesce(CAST(nullif(PositiveFeedback, 0) AS DOUBLE),
         (SELECT median(CAST(nullif(PositiveFeedback, 0) AS DOUBLE)) FROM staging_reviews)) AS Feedback
FROM staging_reviews
"""

SQL["correlation_matrix"] = """
WITH d AS (SELECT Recency::DOUBLE AS Recency, Frequency::DOUBLE AS Frequency, Monetary::DOUBLE AS Monetary,
                  AvgOrderValue::DOUBLE AS AvgOrderValue, ChurnLabel::DOUBLE AS ChurnLabel FROM dim_customer)
SELECT 'Frequency' AS ColumnA, 'Recency' AS ColumnB, round(corr(Recency, Frequency), 6) AS R FROM d
UNION ALL SELECT 'Monetary', 'Recency', round(corr(Recency, Monetary), 6) FROM d
UNION ALL SELECT 'AvgOrderValue', 'Recency', round(corr(Recency, AvgOrderValue), 6) FROM d
UNION ALL SELECT 'ChurnLabel', 'Recency', round(corr(Recency, ChurnLabel), 6) FROM d
UNION ALL SELECT 'Monetary', 'Frequency', round(corr(Frequency, Monetary), 6) FROM d
UNION ALL SELECT 'AvgOrderValue', 'Frequency', round(corr(Frequency, AvgOrderValue), 6) FROM d
UNION ALL SELECT 'ChurnLabel', 'Frequency', round(corr(Frequency, ChurnLabel), 6) FROM d
UNION ALL SELECT 'AvgOrderValue', 'Monetary', round(corr(Monetary, AvgOrderValue), 6) FROM d
UNION ALL SELECT 'ChurnLabel', 'Monetary', round(corr(Monetary, ChurnLabel), 6) FROM d
UNION ALL SELECT 'ChurnLabel', 'AvgOrderValue', round(corr(AvgOrderValue, ChurnLabel), 6) FROM d
"""

SQL["histogram_recency"] = """
WITH e AS (SELECT min(Recency)::DOUBLE AS lo, (max(Recency)::DOUBLE - min(Recency)::DOUBLE) / 50 AS w FROM rfm_table)
SELECT CAST(b AS BIGINT) AS Bin, count(Recency) AS Count
FROM range(50) t(b) LEFT JOIN (SELECT Recency, least(floor((Recency::DOUBLE - lo) / w), 49) AS s FROM rfm_table, e) ON s = b
GROUP BY b
"""

SQL["histogram_review_length"] = """
WITH e AS (SELECT min(ReviewLength)::DOUBLE AS lo, (max(ReviewLength)::DOUBLE - min(ReviewLength)::DOUBLE) / 30 AS w
           FROM clean_reviews)
SELECT CAST(b AS BIGINT) AS Bin, count(ReviewLength) AS Count
FROM range(30) t(b) LEFT JOIN (SELECT ReviewLength, least(floor((ReviewLength::DOUBLE - lo) / w), 29) AS s
                               FROM clean_reviews, e) ON s = b
GROUP BY b
"""

SQL["value_counts_region"] = """
SELECT Region, count(*) AS Count, round(count(*)::DOUBLE * 100 / (SELECT count(*) FROM final_customer_dataset), 6) AS Percent
FROM final_customer_dataset GROUP BY Region
"""

SQL["word_frequency"] = """
SELECT Word, count(*) AS Count
FROM (SELECT unnest(regexp_split_to_array(lower(ReviewText), '[^\\p{L}\\p{N}_'']+')) AS Word FROM clean_reviews)
WHERE Word <> '' AND Word NOT IN (SELECT Word FROM lexicon)
GROUP BY Word ORDER BY count(*) DESC, Word LIMIT 150
"""

SQL["vector_class_mean"] = """
SELECT CAST(label AS BIGINT) AS label, count(DISTINCT vec_id) AS Vectors, round(avg(CAST(v AS DOUBLE)), 6) AS MeanValue
FROM (SELECT vec_id, label, unnest(embedding) AS v FROM embeddings) GROUP BY label
"""

_REVIEW_CELLS = [c for _, c, _ in _columns("staging_reviews")]

SQL["dataset_summary"] = f"""
SELECT 'reviews' AS Dataset, count(*) AS Rows, CAST({len(_REVIEW_CELLS)} AS BIGINT) AS Columns,
       round(({len(_REVIEW_CELLS)} * count(*) - {" - ".join(f"count({c})" for c in _REVIEW_CELLS)})::DOUBLE * 100 / (count(*) * {len(_REVIEW_CELLS)}), 6) AS MissingPercent,
       CAST(sum({" + ".join(f"coalesce(length(CAST({c} AS VARCHAR)), 0)" for c in _REVIEW_CELLS)}) AS BIGINT) AS TextChars
FROM staging_reviews
UNION ALL
SELECT 'retail', count(*), 8, round((count(*) - count(CustomerID))::DOUBLE * 100 / (count(*) * 8), 6),
       CAST(sum(length(Invoice) + length(StockCode) + length(Description) + length(CAST(Quantity AS VARCHAR)) + length(CAST(CAST(InvoiceDate AS TIMESTAMP) AS VARCHAR))
                + length(CAST(Price AS VARCHAR)) + coalesce(length(CAST(CAST(CustomerID AS DOUBLE) AS VARCHAR)), 0) + length(Country)) AS BIGINT)
FROM staging_retail
"""

SQL["event_calendar"] = """
SELECT CAST(year(ts) AS BIGINT) AS Year, CAST(month(ts) AS BIGINT) AS Month, dayname(ts) AS DayOfWeek,
       CAST(hour(ts) AS BIGINT) AS Hour, CAST(CASE WHEN dayofweek(ts) IN (0, 6) THEN 1 ELSE 0 END AS BIGINT) AS IsWeekend,
       CAST(quarter(ts) AS BIGINT) AS Quarter, count(*) AS Events
FROM events GROUP BY 1, 2, 3, 4, 5, 6
"""

SQL["customer_ltv"] = """
SELECT CAST(s.CustomerID AS BIGINT) AS CustomerID, RFM_Segment, Country, CAST(ltv AS DOUBLE) AS LifetimeValue, TotalOrders,
       round(CAST(ltv AS DOUBLE) / lines, 6) AS AvgOrderValue, CAST(Recency AS BIGINT) AS Recency, Frequency,
       CAST(Monetary AS DOUBLE) AS Monetary
FROM (SELECT CustomerID, sum(TotalPrice) AS ltv, count(DISTINCT InvoiceNo) AS TotalOrders, count(*) AS lines
      FROM fact_orders GROUP BY CustomerID) f JOIN segmented s ON f.CustomerID = s.CustomerID
ORDER BY ltv DESC, s.CustomerID LIMIT 20
"""

# --- segments ----------------------------------------------------------------------------------------------

SQL["rfm_scaled"] = """
SELECT CAST(CustomerID AS BIGINT) AS CustomerID, round(r, 6) AS Recency, round(f, 6) AS Frequency, round(m, 6) AS Monetary
FROM rfm_z
"""

SQL["segment_labels"] = """
SELECT CAST(Cluster AS BIGINT) AS Cluster, RFM_Segment, round(Recency, 2) AS Recency, round(Frequency, 2) AS Frequency,
       round(Monetary, 2) AS Monetary
FROM segment_names
"""

SQL["davies_bouldin"] = """
WITH c AS (SELECT Cluster, avg(r) AS r, avg(f) AS f, avg(m) AS m FROM assigned GROUP BY Cluster),
     s AS (SELECT a.Cluster, c.r, c.f, c.m, avg(sqrt((a.r - c.r) ** 2 + (a.f - c.f) ** 2 + (a.m - c.m) ** 2)) AS s
           FROM assigned a JOIN c ON a.Cluster = c.Cluster GROUP BY 1, 2, 3, 4)
SELECT round(avg(w), 6) AS DaviesBouldin
FROM (SELECT x.Cluster, max((x.s + y.s) / sqrt((x.r - y.r) ** 2 + (x.f - y.f) ** 2 + (x.m - y.m) ** 2)) AS w
      FROM s x JOIN s y ON x.Cluster <> y.Cluster GROUP BY x.Cluster)
"""

SQL["kmeans_sweep"] = """
WITH b AS MATERIALIZED (SELECT k, c, cost FROM kmeans_best), z AS MATERIALIZED (SELECT CustomerID, r, f, m FROM rfm_z),
a AS MATERIALIZED (
    SELECT k, CustomerID, r, f, m, list_position(d, list_min(d)) AS cl
    FROM (SELECT b.k, z.*, list_transform(c, lambda y: round((y.r - z.r) * (y.r - z.r) + (y.f - z.f) * (y.f - z.f) + (y.m - z.m) * (y.m - z.m), 9)) AS d FROM b, z)),
s AS (SELECT k, cl, count(*) AS n FROM a GROUP BY k, cl),
t AS (SELECT y.k, x.CustomerID, y.cl, sum(sqrt((x.r - y.r) ** 2 + (x.f - y.f) ** 2 + (x.m - y.m) ** 2)) AS t FROM z x, a y GROUP BY y.k, x.CustomerID, y.cl),
v AS (SELECT a.k, a.CustomerID, max(t / (n - 1)) FILTER (t.cl = a.cl AND n > 1) AS own, min(t / n) FILTER (t.cl <> a.cl) AS other
      FROM a JOIN t ON a.k = t.k AND a.CustomerID = t.CustomerID JOIN s ON s.k = t.k AND s.cl = t.cl GROUP BY a.k, a.CustomerID),
q AS (SELECT k, avg(CASE WHEN own IS NULL OR other IS NULL OR greatest(own, other) = 0 THEN 0 ELSE (other - own) / greatest(own, other) END) AS q FROM v GROUP BY k),
m AS (SELECT k, cl, avg(r) AS r, avg(f) AS f, avg(m) AS m FROM a GROUP BY k, cl),
w AS (SELECT a.k, a.cl, m.r, m.f, m.m, avg(sqrt((a.r - m.r) ** 2 + (a.f - m.f) ** 2 + (a.m - m.m) ** 2)) AS s FROM a JOIN m ON a.k = m.k AND a.cl = m.cl GROUP BY 1, 2, 3, 4, 5),
i AS (SELECT k, avg(w) AS i FROM (SELECT x.k, x.cl, max((x.s + y.s) / sqrt((x.r - y.r) ** 2 + (x.f - y.f) ** 2 + (x.m - y.m) ** 2)) AS w
                                  FROM w x JOIN w y ON x.k = y.k AND x.cl <> y.cl GROUP BY x.k, x.cl) GROUP BY k)
SELECT CAST(b.k AS BIGINT) AS K, round(cost, 4) AS WCSS, round(q, 5) AS Silhouette, round(i, 5) AS DaviesBouldin
FROM b JOIN q ON b.k = q.k JOIN i ON b.k = i.k
"""

SQL["rfm_segments"] = """
WITH c AS (SELECT list_sort(c) AS c FROM kmeans_best WHERE k = 5),
a AS (SELECT CustomerID, Recency, Frequency, Monetary, list_position(d, list_min(d)) - 1 AS cl
      FROM (SELECT z.*, list_transform(c, lambda y: round((y.r - z.r) * (y.r - z.r) + (y.f - z.f) * (y.f - z.f) + (y.m - z.m) * (y.m - z.m), 9)) AS d FROM rfm_z z, c)),
m AS (SELECT cl, avg(Recency) AS Recency, avg(Frequency) AS Frequency, avg(CAST(Monetary AS DOUBLE)) AS Monetary FROM a GROUP BY cl),
l AS (SELECT m.*, CASE WHEN Recency < r AND Frequency > f AND Monetary > mm THEN 'Champions' WHEN Recency < r AND Frequency > f THEN 'Loyal'
                       WHEN Recency < r THEN 'New Customers' WHEN Recency > r75 THEN 'Lost' ELSE 'At Risk' END AS label
      FROM m, (SELECT median(Recency) AS r, median(Frequency) AS f, median(Monetary) AS mm, quantile_cont(Recency, 0.75) AS r75 FROM m)),
n AS (SELECT cl, label, row_number() OVER (PARTITION BY label ORDER BY cl) AS n FROM l)
SELECT CAST(a.CustomerID AS BIGINT) AS CustomerID, CAST(a.cl AS BIGINT) AS Cluster, concat(label, CASE WHEN n = 1 THEN '' ELSE concat(' ', CAST(n AS VARCHAR)) END) AS RFM_Segment
FROM a JOIN n ON a.cl = n.cl
"""

SQL["churn_by_segment"] = """
SELECT RFM_Segment, count(*) AS TotalCustomers, CAST(sum(ChurnLabel) AS BIGINT) AS ChurnedCustomers,
       round(CAST(sum(ChurnLabel) AS DOUBLE) * 100 / count(*), 6) AS ChurnRatePercent
FROM segmented GROUP BY RFM_Segment
"""

SQL["segment_profile"] = """
SELECT RFM_Segment, count(*) AS CustomerCount, round(avg(Recency), 6) AS AvgRecency, round(avg(Frequency), 6) AS AvgFrequency,
       round(CAST(sum(Monetary) AS DOUBLE) / count(*), 6) AS AvgMonetary, CAST(min(Monetary) AS DOUBLE) AS MinMonetary,
       CAST(max(Monetary) AS DOUBLE) AS MaxMonetary
FROM segmented GROUP BY RFM_Segment
"""

SQL["segment_shares"] = """
SELECT RFM_Segment, count(*) AS Customers, round(avg(Recency), 6) AS AvgRecency, round(avg(Frequency), 6) AS AvgFrequency,
       round(avg(CAST(Monetary AS DOUBLE)), 6) AS AvgMonetary,
       round(count(*)::DOUBLE * 100 / (SELECT count(*) FROM segmented), 6) AS Percent
FROM segmented GROUP BY RFM_Segment
"""

# --- churn models ------------------------------------------------------------------------------------------

SQL["churn_features"] = """
SELECT CAST(CustomerID AS BIGINT) AS CustomerID, greatest(f1, least(f99, fr)) AS Frequency,
       greatest(m1, least(m99, mo)) AS Monetary, greatest(u1, least(u99, un)) AS UniqueProducts,
       li AS CustomerLifespanDays, (dense_rank() OVER (ORDER BY coalesce(Region, 'Unknown')) - 1)::DOUBLE AS Region,
       greatest(p1, least(p99, AvgPricePerItem)) AS AvgPricePerItem,
       CategoryDiversity::DOUBLE AS CategoryDiversity, WeekendRatio AS WeekendRatio,
       PremiumRatio AS PremiumRatio, LastPurchaseMonth::DOUBLE AS LastPurchaseMonth,
       round(SpendingStdDev, 2) AS SpendingStdDev, mo / (un + 1) AS MonetaryPerProduct,
       (mo > m50)::INT::DOUBLE AS HighValue, (fr = 1)::INT::DOUBLE AS IsOneTimeBuyer, (mo < m25)::INT::DOUBLE AS LowSpender,
       fr / (li + 1) AS OrdersPerLifespan, (li + 1) / (fr + 1) AS AvgDaysBetweenOrders,
       mo / (li + 1) AS MonetaryPerLifespan, round(ln(1 + li), 6) AS LogLifespan, round(ln(1 + mo), 6) AS LogMonetary,
       round(ln(1 + fr), 6) AS LogFrequency, mo / (fr + 1) AS MonetaryFrequencyRatio,
       fr / (un + 1) AS FrequencyPerProduct, fr * fr AS FrequencySquared,
       (fr > f50 AND mo > m50)::INT::DOUBLE AS HighFrequencyHighValue,
       round(SpendingStdDev / (mo / (fr + 1) + 1), 6) AS SpendingConsistency
FROM churn_wide, churn_limits
"""

SQL["churn_split"] = """
SELECT split, CAST(ChurnLabel AS BIGINT) AS label, count(*) AS Rows FROM splits GROUP BY 1, 2
"""

SQL["class_weights"] = """
SELECT CAST(CustomerID AS BIGINT) AS CustomerID, CAST(r.ChurnLabel AS BIGINT) AS ChurnLabel,
       round((SELECT count(*)::DOUBLE / count(DISTINCT ChurnLabel) FROM rfm_table) / n, 6) AS weight
FROM rfm_table r JOIN (SELECT ChurnLabel, count(*) AS n FROM rfm_table GROUP BY 1) s ON r.ChurnLabel = s.ChurnLabel
"""

SQL["soft_vote"] = """
SELECT CAST(CustomerID AS BIGINT) AS CustomerID, CAST(label AS BIGINT) AS label, round(score, 6) AS score,
       (vote.score >= 0.5)::BIGINT AS prediction
FROM vote
"""

SQL["threshold_table"] = """
SELECT Model, round(Threshold, 3) AS Threshold, CAST(sum((score >= Threshold)::INT * label) AS BIGINT) AS TP,
       CAST(sum((score >= Threshold)::INT) AS BIGINT) AS Predicted, CAST(sum(label) AS BIGINT) AS Positives, count(*) AS Rows
FROM curve_scores, thresholds GROUP BY Model, thresholds.Threshold
"""

SQL["threshold_tuning"] = "SELECT Model, Threshold, round(Accuracy, 6) AS Accuracy FROM tuned"

SQL["auc"] = """
SELECT Model, round((sum(CASE WHEN label = 1 THEN r END) - p * (p + 1) / 2) / (p * (n - p)), 6) AS AUC
FROM (SELECT Model, label, rank() OVER (PARTITION BY Model ORDER BY score)
             + (count(*) OVER (PARTITION BY Model, score) - 1) / 2.0::DOUBLE AS r,
             sum(label) OVER (PARTITION BY Model) AS p, count(*) OVER (PARTITION BY Model) AS n
      FROM curve_scores) GROUP BY Model, p, n
"""

SQL["confusion_matrix"] = """
SELECT CAST(label AS BIGINT) AS Actual, (score >= 0.5)::BIGINT AS Predicted, count(*) AS Rows FROM vote GROUP BY 1, 2
"""

SQL["class_report"] = """
WITH v AS (SELECT label, (score >= 0.5)::INT AS guess FROM vote),
     k AS (SELECT unnest([0, 1]) AS c),
     t AS (SELECT c, sum((label = c AND guess = c)::INT) AS t, sum((guess = c)::INT) AS p, sum((label = c)::INT) AS s
           FROM v, k GROUP BY c)
SELECT CAST(c AS BIGINT) AS Class, round(coalesce(t::DOUBLE / nullif(p, 0), 0), 6) AS Precision,
       round(coalesce(t::DOUBLE / nullif(s, 0), 0), 6) AS Recall,
       round(coalesce(t::DOUBLE * 2 / nullif(p + s, 0), 0), 6) AS F1, CAST(s AS BIGINT) AS Support
FROM t WHERE p + s > 0
"""

SQL["roc_curve"] = """
SELECT Model, round(b / 1000.0::DOUBLE, 6) AS Threshold,
       round(CAST(sum(n - p) OVER w AS DOUBLE) / CAST(sum(n - p) OVER (PARTITION BY Model) AS DOUBLE), 6) AS FPR,
       round(CAST(sum(p) OVER w AS DOUBLE) / CAST(sum(p) OVER (PARTITION BY Model) AS DOUBLE), 6) AS TPR
FROM (SELECT Model, least(floor(score * 1000), 999) AS b, sum(label) AS p, count(*) AS n FROM curve_scores GROUP BY 1, 2)
WINDOW w AS (PARTITION BY Model ORDER BY b DESC ROWS UNBOUNDED PRECEDING)
"""

SQL["model_metrics"] = """
SELECT Model, round(Threshold, 6) AS Threshold, round((n - pos - pred + 2 * tp)::DOUBLE / n, 6) AS Accuracy,
       round(tp::DOUBLE / nullif(pred, 0), 6) AS Precision, round(tp::DOUBLE / nullif(pos, 0), 6) AS Recall,
       round(2 * tp::DOUBLE / (pred + pos), 6) AS F1_Score, round(auc, 6) AS AUC
FROM test_metrics
"""

SQL["best_model"] = """
SELECT Model, round(2 * tp::DOUBLE / (pred + pos), 6) AS F1_Score FROM test_metrics ORDER BY F1_Score DESC, Model LIMIT 1
"""


SQL["csv_staging"] = """
SELECT Country, count(*) AS Lines, CAST(sum(Quantity) AS BIGINT) AS Quantity, CAST(sum(Quantity * Price) AS DOUBLE) AS Amount,
       count(*) - count(CustomerID) AS Unknown, CAST(sum(length(Description)) AS BIGINT) AS TextChars,
       strftime(max(InvoiceDate), '%Y-%m-%d %H:%M:%S') AS LastDate
FROM staging_retail GROUP BY Country
"""

SQL["rejected_lines"] = """
SELECT CASE WHEN Quantity <= 0 OR Price <= 0 THEN 'rejected' ELSE 'kept' END AS Output, count(*) AS Lines,
       CAST(sum(Quantity) AS BIGINT) AS Quantity
FROM staging_retail GROUP BY 1
"""

SQL["replaced_table"] = """
SELECT DayOfWeek, count(*) AS Days, CAST(sum(IsWeekend) AS BIGINT) AS Weekend FROM dim_time
WHERE DayOfWeek IN ('Friday', 'Saturday', 'Sunday') GROUP BY DayOfWeek
"""

SQL["first_csv"] = "SELECT Country, Region FROM dim_location"

SQL["review_names"] = """
SELECT ReviewID, CAST(Age AS DOUBLE) AS Age, Rating + 0.5::DOUBLE AS Stars, TRY_CAST(DepartmentName AS DOUBLE) AS Department
FROM staging_reviews
"""


# The same answer with short heads, so that most neighbours come from the join behind them.
SQL["user_similarity_tail"] = SQL["user_similarity_topk"]


SQL["versioned_write_back"] = """
SELECT ReviewID, CAST(Rating AS BIGINT) AS Rating,
       CASE WHEN ReviewID >= (SELECT max(ReviewID) FROM scored_reviews) * 9 / 10 THEN round(Ensemble_Score, 6) END AS SentimentScore FROM scored_reviews
"""

SQL["image_folder_counts"] = """
SELECT concat('class-', page_id % 7) AS Label, count(*) AS Files, CAST(sum(strlen(coalesce(html, '')) + 1) AS BIGINT) AS Bytes FROM pages GROUP BY 1
"""

SQL["saved_scaler"] = """
SELECT CAST(CustomerID AS BIGINT) AS CustomerID, round((Recency - avg(Recency) OVER ()) / stddev_samp(Recency) OVER (), 6) AS Recency,
       round((Frequency - avg(Frequency) OVER ()) / stddev_samp(Frequency) OVER (), 6) AS Frequency,
       round((Monetary::DOUBLE - avg(Monetary::DOUBLE) OVER ()) / stddev_samp(Monetary::DOUBLE) OVER (), 6) AS Monetary
FROM rfm_table
"""


def statements() -> dict[str, str]:
    return {name: with_views(sql) for name, sql in SQL.items()}
