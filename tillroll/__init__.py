"""Order and product-catalogue analytics written as Spark DataFrame operators."""
