-- Top 100 households by observed sales; ties by household.
SELECT household_key, total_sales, transaction_count, average_basket_value, total_quantity,
       recency_days
FROM {customer_features}
ORDER BY total_sales DESC, household_key
LIMIT 100
