-- Task dashboard: open capacity-study tasks per part and supplier.
SELECT ps.PartNumber,
       ps.SupplierCode,
       count(t.PartSupplierTaskID) AS task_count,
       cast(sum(CASE WHEN t.StatusID = 3 THEN 1 ELSE 0 END) AS bigint) AS approved_count,
       max(coalesce(t.ModifyDate, t.CreateDate)) AS last_update
FROM portal_part_supplier ps
LEFT JOIN portal_task t
  ON t.PartSupplierID = ps.PartSupplierID AND t.TaskID = 40
GROUP BY ps.PartNumber, ps.SupplierCode
