"""Join and window operators built from DataFrame primitives (size-checked broadcasts, as-of join, salting, running sums, trailing windows)."""
