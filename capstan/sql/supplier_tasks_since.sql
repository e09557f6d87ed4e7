-- Tasks of one kind changed since :since, per supplier; {braces} and 'portal_task' in text stay as they are.
SELECT ps.SupplierCode,
       count(*) AS task_count,
       count_if(portal_task.StatusID IN (:open_status, :review_status)) AS open_count,
       max(coalesce(portal_task.ModifyDate, portal_task.CreateDate)) AS last_update,
       'portal_task {' AS source_name
FROM PORTAL_TASK
JOIN portal_part_supplier ps ON ps.PartSupplierID = portal_task.PartSupplierID
WHERE portal_task.TaskID = :task_id
  AND coalesce(portal_task.ModifyDate, portal_task.CreateDate) >= :since
GROUP BY ps.SupplierCode
