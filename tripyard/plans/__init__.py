"""Layer plans: staging -> silver -> gold, analytics and data-quality gates."""
