"""Plan building blocks shared by the operators: staging, checked lookups, skew-safe running values."""
