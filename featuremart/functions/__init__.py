"""Column functions: cleansing, code classes, remark rules, dates, money."""
