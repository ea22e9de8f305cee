-- Coupon behaviour of households with demographics, per observed segment code.
SELECT classification_1, COUNT(*) AS households,
       AVG(coupon_usage) AS average_coupon_discounted_baskets,
       SUM(coupon_redemption_count) AS coupon_redemption_rows
FROM {customer_features} JOIN {household_demographics} USING (household_key)
GROUP BY classification_1
ORDER BY average_coupon_discounted_baskets DESC, classification_1
