-- Sales per household and department; products without a department form their own group.
SELECT household_key, DEPARTMENT, CAST(SUM(sales) AS DOUBLE) AS total_sales
FROM (SELECT household_key, PRODUCT_ID, SUM(SALES_VALUE) AS sales
      FROM {feature_transactions}
      GROUP BY household_key, PRODUCT_ID)
JOIN {products} USING (PRODUCT_ID)
GROUP BY household_key, DEPARTMENT
ORDER BY household_key, total_sales DESC, DEPARTMENT
