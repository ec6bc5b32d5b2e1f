"""Operations on DataFrames."""
