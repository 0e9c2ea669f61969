"""Study harmonisation plans, the person x sweep panel and the published counts."""
