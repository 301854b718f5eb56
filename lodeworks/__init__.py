"""Operations-KPI warehouse on Spark: staging, shift KPIs, feature tables, yearbook and price marts."""
